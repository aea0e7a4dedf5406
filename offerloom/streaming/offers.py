"""Offers as a stream: new files are deduplicated, counted by day with late rows allowed for, and appended."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.names import supplier_key


def read_stream(spark: SparkSession, folder: str, schema) -> DataFrame:
    """A folder of parquet files as they arrive."""
    return spark.readStream.schema(schema).parquet(folder)


def new_offers(offers: DataFrame, delay: str = "14 days") -> DataFrame:
    """Each offer key once within the delay; later repeats of a key that came before the watermark pass again."""
    return offers.withColumn("at", F.col("extracted_at").cast("timestamp")).withWatermark("at", delay).dropDuplicatesWithinWatermark(["offer_key"])


def daily_counts(offers: DataFrame, delay: str = "14 days") -> DataFrame:
    """Offers by supplier and day of extraction; a day is closed once the watermark has passed it."""
    rows = offers.select(supplier_key(F.col("supplier")).alias("supplier"), F.col("extracted_at").cast("timestamp").alias("at")).withWatermark("at", delay)
    days = rows.groupBy(F.window("at", "1 day").alias("w"), "supplier").agg(F.count(F.lit(1)).alias("offers"))
    return days.select(F.col("w.start").cast("date").alias("day"), "supplier", "offers")


def append(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Writes all that is there now as parquet and ends; started again with the same checkpoint it takes only what is new."""
    return stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
