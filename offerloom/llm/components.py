"""Groups of linked records: connected components by randomised contraction.

Every round each vertex hooks to the member of its closed neighbourhood that a fresh hash puts first; edges are
relabelled and deduplicated, and the rounds end when no edge is left. The expected number of vertices falls by a
constant factor a round whatever the shape, so long chains take as few rounds as stars. The rounds' mappings are then
expanded from the last to the first, each join no larger than its round.

Skew: a hub's edges are reduced by min_by, which combines map-side, and after one round most of them are duplicates.
Joins look up one mapping row for each vertex. The edges of a vertex with more than HOT_DEGREE of them, the vertices that
hook to it, and the members of a large group are dealt to several tasks; such vertices number at most twice the edges
divided by HOT_DEGREE, which bounds their broadcast (a billion edges: 20,000 ids).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import looked_up
from ..session import Scratch

#: A vertex with more edges, or a group with more members, than this is hot: they go to one task for each so many.
HOT_DEGREE = 100_000


def _relabel(edges: DataFrame, mapping: DataFrame, column: str, hot: DataFrame | None) -> DataFrame:
    """edges with column replaced by its representative."""
    names = mapping.select(F.col("vertex").alias(column), "rep")
    some = None if hot is None else hot.withColumnRenamed("vertex", column)
    return looked_up(edges, column, names, some, "a", "b").drop(column).withColumnRenamed("rep", column)


def linked_groups(pairs: DataFrame, left: str, right: str, seed: int = 7) -> DataFrame:
    """One row for each linked id: id, group_id, the smallest id of all directly or indirectly linked ones.

    Pairs with a null on either side and pairs of an id with itself link nothing; repeats and both directions count
    once. Ids are compared as they stand, as strings. An empty table gives no rows.
    """
    box = Scratch(pairs.sparkSession, "linked")
    a, b = F.col(f"`{left}`").cast("string"), F.col(f"`{right}`").cast("string")
    one = F.count(F.lit(1))
    edges, seen = box.measured(pairs.where(a != b).select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct(), n=one)
    rounds: list[tuple[DataFrame, DataFrame | None]] = []
    while seen["n"]:
        order = lambda c, r=len(rounds): F.struct(F.xxhash64(F.lit(seed + r), c).alias("h"), c.alias("v"))
        ends = F.explode(F.array(F.struct(F.col("a").alias("v"), F.col("b").alias("o")), F.struct(F.col("b").alias("v"), F.col("a").alias("o")))).alias("e")
        near = edges.select(ends).groupBy(F.col("e.v").alias("vertex")).agg(F.min(order(F.col("e.o"))).alias("first"), F.count(F.lit(1)).alias("degree"))
        mapping, top = box.measured(near.select("vertex", F.least("first", order(F.col("vertex")))["v"].alias("rep"), "degree"), degree=F.max("degree"))
        deals = F.ceil(F.col("degree") / HOT_DEGREE).cast("int").alias("deals")
        hot = mapping.where(F.col("degree") > HOT_DEGREE).select("vertex", deals) if top["degree"] > HOT_DEGREE else None
        rounds.append((mapping, hot))
        moved = _relabel(_relabel(edges, mapping, "a", hot), mapping, "b", hot).where("a != b")
        after, seen = box.measured(moved.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), n=one)
        box.drop(edges)
        edges = after
    if not rounds:
        return edges.select(F.col("a").alias("id"), F.col("b").alias("group_id"))
    final = rounds.pop()[0].select("vertex", "rep")
    while rounds:
        mapping, hot = rounds.pop()
        # A representative without a further mapping keeps itself; what hooks to a vertex are neighbours of it.
        own = mapping.select("rep").distinct().join(final.select(F.col("vertex").alias("rep"), F.col("rep").alias("end")), "rep", "left").select("rep", F.coalesce("end", "rep").alias("end"))
        after = box.keep(looked_up(mapping.select("vertex", "rep"), "rep", own, hot and hot.withColumnRenamed("vertex", "rep"), "vertex").select("vertex", F.col("end").alias("rep")))
        box.drop(mapping)
        final = after
    groups = box.keep(final.groupBy("rep").agg(F.min("vertex").alias("group_id"), F.count(F.lit(1)).alias("n")))
    large = groups.where(F.col("n") > HOT_DEGREE).select("rep", F.ceil(F.col("n") / HOT_DEGREE).cast("int").alias("deals"))
    out = looked_up(final, "rep", groups.select("rep", "group_id"), None if large.isEmpty() else large, "vertex")
    return out.select(F.col("vertex").alias("id"), "group_id")
