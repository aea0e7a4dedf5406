"""Operators on texts and urls: content hashes, greedy duplicates, log lines."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# How a failed extraction is logged.
FAILED = r"ERROR extract (\w+)/(\d{4})/(\d{1,2}) (\w+) failed after (\d+) attempts"


def first_by_content(df: DataFrame, row: str, content: str) -> DataFrame:
    """row, hash, copies: the first row of each content (SHA-256), with the number of rows that hold it; nulls are none."""
    hashed = df.where(F.col(content).isNotNull()).select(row, F.sha2(content, 256).alias("hash"))
    return hashed.groupBy("hash").agg(F.min(row).alias(row), F.count(F.lit(1)).alias("copies"))


def failed_keys(df: DataFrame, text: str) -> DataFrame:
    """supplier, year, week, page and the number of lines that report each as failed, whatever the attempts."""
    lines = df.where(F.col(text).contains("ERROR extract")).select(F.explode(F.regexp_extract_all(text, F.lit(FAILED), F.lit(0))).alias("line"))
    part = lambda i: F.regexp_extract("line", FAILED, i)
    return lines.groupBy(part(1).alias("supplier"), part(2).cast("int").alias("year"), part(3).cast("int").alias("week"), part(4).alias("page")).agg(F.count(F.lit(1)).alias("lines"))


def log_events(df: DataFrame, text: str) -> DataFrame:
    """The JSON lines of log texts: timestamp, level, logger, message, duration_ms; lines that are none fall out."""
    schema = "timestamp string, level string, logger string, message string, duration_ms bigint"
    lines = df.where(F.col(text).contains('{"timestamp"')).select(F.explode(F.split(text, "\n")).alias("line")).where(F.trim("line").startswith("{"))
    return lines.select(F.from_json(F.trim("line"), schema).alias("e")).where("e.timestamp is not null").select("e.*")


def greedy_distinct(df: DataFrame, group: str, order: str, keys: list[str]) -> DataFrame:
    """Rows in order without those that share any key with an earlier row kept; a dropped row's keys don't count.

    Sequential within a group (one result list), streamed: a task holds the keys seen, not the rows. Null keys match none.
    """
    schema = df.schema

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, seen = object(), set()
        for frame in frames:
            keep = []
            for g, *ks in zip(frame[group], *[frame[k] for k in keys], strict=True):
                if g != now:
                    now, seen = g, set()
                own = {(i, k) for i, k in enumerate(ks) if k is not None and k == k}
                keep.append(not own & seen)
                if keep[-1]:
                    seen |= own
            yield frame[keep]

    return df.repartition(group).sortWithinPartitions(group, order).mapInPandas(run, schema)
