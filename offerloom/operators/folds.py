"""Ordered folds: last values, and blocks of lines that begin with a heading."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ranking import winner


def last_each(df: DataFrame, by: list[str], order: list[Column], columns: list[str]) -> DataFrame:
    """by and columns of the last row of each group in the given order (nulls first); combines map-side."""
    return winner(df, by, order).select(*by, *columns)


def blocks_after_heading(df: DataFrame, doc: str, text: str) -> DataFrame:
    """doc, block, heading, lines, chars: a text's lines from each heading to the next; what stands before the first is none.

    A heading begins with '#' or states a validity, or ends with ':' within 60 signs. The running count of headings is
    the state; null and empty texts have no blocks.
    """
    # Texts without a heading have no block and aren't shuffled.
    texts = df.select(doc, F.transform(F.split(text, "\n"), lambda x: F.trim(x)).alias("lines")).where(F.exists("lines", _heading))
    block = F.sum(_heading(F.col("line")).cast("bigint")).over(Window.partitionBy(doc).orderBy("at"))
    rows = texts.select(doc, F.posexplode("lines").alias("at", "line")).withColumn("block", block).where("block > 0")
    is_head = _heading(F.col("line"))
    return rows.groupBy(doc, "block").agg(F.max(F.when(is_head, F.col("line"))).alias("heading"), F.count_if(~is_head & (F.col("line") != "")).alias("lines"), F.sum(F.when(is_head, 0).otherwise(F.length("line"))).alias("chars"))


def _heading(line: Column) -> Column:
    return line.startswith("#") | line.startswith("Gültig vom ") | (line.endswith(":") & F.length(line).between(2, 60))
