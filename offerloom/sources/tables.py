"""Scans of the table folder: one parquet file or folder per table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    """The table's rows with just the named columns (all, if none is named), so that the scan reads no others."""
    df = spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


def spread(df: DataFrame) -> DataFrame:
    """df over twice as many partitions as there are cores where its scan gives fewer than one each; else as it is.

    For row-wise work in Python on small files. A large scan has more partitions than cores and is never shuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(2 * cores)
