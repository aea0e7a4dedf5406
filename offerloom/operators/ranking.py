"""Winners, top-k, modes, exact duplicates and ordered folds; all by aggregates that combine map-side, so no group is collected."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import Scratch


def winner(df: DataFrame, by: list[str], best: list[Column]) -> DataFrame:
    """The one row of each group that is greatest by best (columns compared one after the other, nulls least)."""
    every = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    return df.groupBy(*by).agg(F.max_by(every, F.struct(*best)).alias("w")).select("w.*")


def top_k(df: DataFrame, k: int, *order: Column) -> DataFrame:
    """The first k rows; each task keeps k."""
    return df.orderBy(*order).limit(k)


def top_k_each(df: DataFrame, by: list[str], k: int, *order: Column) -> DataFrame:
    """The first k rows of each group, numbered; Spark keeps k rows a group before the shuffle."""
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order)).cast("long")).where(F.col("rank") <= k)


def mode_first_seen(df: DataFrame, by: list[str], value: str, order: str) -> DataFrame:
    """The most frequent value of each group (nulls and '' don't count); among equals the one seen first."""
    counts = df.where(F.col(value).isNotNull() & (F.col(value) != "")).groupBy(*by, value).agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("first"))
    return counts.groupBy(*by).agg(F.max_by(F.struct(F.col(value), "n"), F.struct("n", -F.col("first"))).alias("m")).select(*by, F.col(f"m.{value}").alias(value), F.col("m.n").alias("n"))


def last_until_sure(df: DataFrame, by: list[str], row: str, order: str, sure: Column) -> DataFrame:
    """A fold in order that replaces its row by the next until a row is sure: the first sure row, else the last one."""
    o = F.col(order)
    kept = df.groupBy(*by).agg(F.min_by(F.when(sure, F.col(row)), F.when(sure, o)).alias("sure"), F.max_by(row, order).alias("last"), F.count(F.lit(1)).alias("n"))
    return kept.select(*by, F.coalesce("sure", "last").alias(row), "n")


def interleaved(df: DataFrame, source: str, rank: list[Column], source_rank: Column) -> DataFrame:
    """round and position: first rows of all sources, then the second ones, and so on.

    Rows are numbered within the parts of a range partitioning and the parts' counts added up, so no task holds a whole
    source; the position follows from the round and the sources' counts. rank must order a source's rows fully.
    """
    parts = df.repartitionByRange(source_rank, F.col(source), *rank).withColumn("part", F.spark_partition_id())
    parts = Scratch(df.sparkSession, "interleaved").keep(parts)
    counts = parts.groupBy(source, "part").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(source_rank.alias("r"))).alias("r"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy(source).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes = counts.groupBy(source).agg(F.sum("n").alias("n"), F.min("r").alias("r"))
    order = F.sort_array(F.collect_list(F.struct("r", source, "n"))).alias("sizes")
    starts = counts.select(F.col(source).alias("of"), F.col("part").alias("in"), before.alias("before"))
    numbered = parts.withColumn("round", F.row_number().over(Window.partitionBy("part", source).orderBy(*rank)))
    numbered = numbered.join(F.broadcast(starts), F.col(source).eqNullSafe(F.col("of")) & (F.col("part") == F.col("in"))).withColumn("round", F.col("round") + F.col("before"))
    full = F.aggregate("sizes", F.lit(0).cast("long"), lambda n, x: n + F.least(x["n"], F.col("round") - 1))
    own = F.struct(F.struct(source_rank.alias("r")).alias("r"), F.col(source).alias(source))
    level = F.size(F.filter("sizes", lambda x: (x["n"] >= F.col("round")) & (F.struct(x["r"].alias("r"), x[source].alias(source)) <= own)))
    placed = numbered.crossJoin(F.broadcast(sizes.agg(order))).withColumn("position", full + level)
    return placed.select(*[F.col(f"`{c}`") for c in df.columns], "round", "position").orderBy("position")
