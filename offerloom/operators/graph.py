"""Clusters of offers over accepted pairs: smallest reachable id, by label spreading with pointer jumps.

Skew: the edges of a hub, and the members of a large cluster that look up one label, are dealt to several tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import Scratch
from . import joins
from .joins import hot_keys, looked_up


def clusters(edges: DataFrame, a: str, b: str) -> DataFrame:
    """id, cluster (its smallest id) of every id on an edge. Labels spread to neighbours and along labels until none changes."""
    box = Scratch(edges.sparkSession, "clusters")
    pairs = edges.where(F.col(a) != F.col(b)).select(F.col(a).alias("x"), F.col(b).alias("y"))
    both = box.keep(pairs.unionByName(pairs.select(F.col("y").alias("x"), F.col("x").alias("y"))).distinct())
    hubs = box.keep(hot_keys(both.select(F.col("y").alias("id")), "id"))
    hubs = None if hubs.isEmpty() else hubs
    labels, size = box.measured(both.groupBy("x").agg(F.least(F.col("x"), F.min("y")).alias("label")).select(F.col("x").alias("id"), "label"), n=F.count(F.lit(1)))
    while True:
        near = looked_up(both.select("x", F.col("y").alias("id")), "id", labels, hubs, "x").groupBy("x").agg(F.min("label").alias("near"))
        step = labels.join(near, F.col("id") == F.col("x")).select("id", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        jump = labels.select(F.col("id").alias("label"), F.col("label").alias("over"))
        crowded = hot_keys(step, "label") if size["n"] > joins.HOT_ROWS else None
        # Every label is an id, so that the look-up finds all.
        jumped = looked_up(step, "label", jump, crowded, "id").select("id", "old", F.least("label", "over").alias("label"))
        after, seen = box.measured(jumped, moved=F.count_if(F.col("old") != F.col("label")))
        box.drop(labels)
        labels = after
        if not seen["moved"]:
            return after.select("id", F.col("label").alias("cluster"))
