"""Continuous periods and gaps of inclusive day intervals, by dyadic blocks.

An interval is cut into its canonical dyadic blocks (start, level), 2**level days long and aligned to their
length. Blocks of one entity either nest or are disjoint, so those inside a larger one fall out by one running
maximum; sibling pairs are merged upward level by level, and what then touches is coalesced.

Skew: equal intervals are merged map-side before any shuffle on the entity. What is left of an entity is bounded by
the calendar (at most two blocks a day of its span), however many rows it had.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Sibling merging stops at blocks of 2**TOP days; the last step coalesces larger runs, so results don't depend on it.
TOP = 12


def dyadic_blocks(df: DataFrame, entity: list[str], start: str, end: str) -> DataFrame:
    """Rows of integer intervals [start, end] as entity, block_start, level; a block once per interval that has it."""
    blocks = f"""flatten(transform(sequence(0, cast(floor(log2({end} - {start} + 1)) as int)), k -> transform(filter(array(
        struct(shiftright({start} + shiftleft(1, k) - 1, k) as i, shiftright({start} + shiftleft(1, k) - 1, k) & 1 as odd),
        struct(shiftright({end} + 1, k) - 1 as i, shiftright({end} + 1, k) & 1 as odd)),
        b -> b.odd = 1 and shiftright({start} + shiftleft(1, k) - 1, k) < shiftright({end} + 1, k)),
        b -> struct(shiftleft(b.i, k) as block_start, k as level))))"""
    return df.select(*entity, F.expr(f"inline({blocks})"))


def merge_blocks(blocks: DataFrame, entity: list[str], top: int = TOP) -> DataFrame:
    """Disjoint blocks of each entity, no two of them siblings below level top. Input partitioned by entity stays so."""
    order = [F.col("block_start"), F.col("level").desc()]
    end = F.col("block_start") + F.expr("shiftleft(1, level)")
    above = F.max(end).over(Window.partitionBy(*entity).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1))
    out = blocks.withColumn("above", above).where(F.col("above").isNull() | (end > F.col("above"))).drop("above")
    w = Window.partitionBy(*entity).orderBy("block_start")
    for k in range(top):
        size = 1 << k
        left = (F.col("level") == k) & (F.col("block_start").bitwiseAND(size) == 0) & (F.col("next_level") == k) & (F.col("next_start") == F.col("block_start") + size)
        right = (F.col("level") == k) & (F.col("block_start").bitwiseAND(size) != 0) & (F.col("last_level") == k) & (F.col("last_start") == F.col("block_start") - size)
        seen = out.select(
            *entity, "block_start", "level",
            F.lead("level").over(w).alias("next_level"), F.lead("block_start").over(w).alias("next_start"),
            F.lag("level").over(w).alias("last_level"), F.lag("block_start").over(w).alias("last_start"),
        )
        kept = seen.where(~F.coalesce(right, F.lit(False)))
        out = kept.select(*entity, "block_start", F.when(F.coalesce(left, F.lit(False)), k + 1).otherwise(F.col("level")).alias("level"))
    return out


def periods_and_gaps(df: DataFrame, entity: list[str], start: str, end: str) -> DataFrame:
    """Each entity's continuous periods and the gaps between them: entity columns, kind, start_date, end_date.

    Dates are inclusive on both ends, and a period that starts the day after another ends continues it. Rows without
    an entity value, a date, or with start after end take no part. Dates come out as yyyy-MM-dd strings, kind is
    'period' or 'gap'. An empty table gives no rows; other columns of the input, whatever their names, are not read.
    """
    own = [f"e{i}" for i in range(len(entity))]
    rows = df.select(*[F.col(f"`{c}`").alias(o) for c, o in zip(entity, own, strict=True)], F.unix_date(F.col(f"`{start}`").cast("date")).alias("s"), F.unix_date(F.col(f"`{end}`").cast("date")).alias("e"))
    rows = rows.where(" and ".join(f"{c} is not null" for c in own) + " and s <= e").distinct()
    blocks = dyadic_blocks(rows.repartition(*own), own, "s", "e").distinct()
    merged = merge_blocks(blocks, own)
    w = Window.partitionBy(*own).orderBy("block_start")
    stop = F.col("block_start") + F.expr("shiftleft(1, level)")
    runs = merged.select(*own, F.col("block_start").alias("s"), stop.alias("t"), (F.col("block_start") == F.lag(stop).over(w)).alias("joins"))
    runs = runs.withColumn("run", F.sum(F.when(F.col("joins"), 0).otherwise(1)).over(Window.partitionBy(*own).orderBy("s").rowsBetween(Window.unboundedPreceding, 0)))
    periods = runs.groupBy(*own, "run").agg(F.min("s").alias("s"), F.max("t").alias("t"))
    periods = periods.withColumn("last", F.lag("t").over(Window.partitionBy(*own).orderBy("s")))
    both = F.expr("filter(array(struct('period' as kind, s as a, t - 1 as b), struct('gap' as kind, last as a, s - 1 as b)), x -> x.a is not null)")
    day = lambda c: F.date_format(F.date_from_unix_date(F.col(c)), "yyyy-MM-dd")
    out = periods.select(*own, F.inline(both))
    return out.select(*[F.col(o).alias(c) for c, o in zip(entity, own, strict=True)], "kind", day("a").alias("start_date"), day("b").alias("end_date"))
