"""The weekly comparison as one plan: offers to exact duplicates, keyword matches, prices side by side and their spread."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text
from ..functions.names import supplier_key
from ..operators.joins import containment_join
from ..sources.tables import table

SUPPLIERS = ("edeka", "handelshof", "metro", "selgros")


def comparison(spark: SparkSession, folder: str) -> DataFrame:
    """One row for each listed product: offers, the lowest stated price of each supplier, and the spread in percent."""
    o = table(spark, folder, "offers", "product_name", "supplier", "price_per_kg")
    rows = o.select(text.key_text(o.product_name).alias("name"), supplier_key(o.supplier).alias("s"), F.when((o.price_per_kg > 0) & ~F.isnan("price_per_kg") & ~o.price_per_kg.isin(9999.0, 99999.99), F.round("price_per_kg", 4)).alias("p"))
    best = rows.groupBy("name", "s").agg(F.min("p").alias("p"), F.count(F.lit(1)).alias("n"))
    canon = table(spark, folder, "canonical_products", "canonical_name", "keywords").select("canonical_name", F.explode(F.split("keywords", ",")).alias("k"))
    match = containment_join(best, "name", canon.select("canonical_name", text.key_text(F.col("k")).alias("keyword")), "keyword", "canonical_name")
    wide = best.join(match, "name").groupBy("canonical_name").agg(F.sum("n").alias("offers"), *[F.min(F.when(F.col("s") == s, F.col("p"))).alias(s) for s in SUPPLIERS])
    low, high = F.least(*SUPPLIERS), F.greatest(*SUPPLIERS)
    return wide.withColumn("spread", F.round((high - low) / low * 100, 2))
