"""Queries of the training-data problems 2 to 4 and 6 to 9, with SQL where DuckDB can state them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import table
from . import abuse
from .canonical import map_to_list
from .components import linked_groups
from .leaks import MARKED, MISREAD, PLAIN, leaks, passages
from .listings import product_groups, read_listings, same_product_pairs
from .survivors import FILL_IN_ORIGINS, NAMES_COUNTRY, survivors, unknown_origin, usable_origin, usable_price
from .tokens import corpus_ids

# The decisions that link two products.
LINKING = ("exact_match", "close_comparable")


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    pairs = table(spark, folder, "pair_decisions", "product_id_a", "product_id_b", "decision").where(F.col("decision").isin(*LINKING))
    key = lambda c: F.nullif(F.regexp_replace(F.lower(c), r"(?U)^\s+|\s+$", ""), F.lit(""))
    ids = pairs.select(key(F.col("product_id_a")).alias("a"), key(F.col("product_id_b")).alias("b"))
    return linked_groups(ids, "a", "b").withColumnRenamed("id", "product_id")


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    canon = table(spark, folder, "canonical_products", "canonical_name", "keywords")
    return map_to_list(table(spark, folder, "offers", "ord", "product_name"), "ord", "product_name", canon, "canonical_name", "keywords")


def p3_ways(spark: SparkSession, folder: str) -> DataFrame:
    """How many rows are settled by listed forms, by the pigeonhole join, and not at all."""
    canon = table(spark, folder, "canonical_products", "canonical_name", "keywords")
    mapped = map_to_list(table(spark, folder, "offers", "ord", "product_name"), "ord", "product_name", canon, "canonical_name", "keywords", way="way")
    return mapped.groupBy("way").agg(F.count(F.lit(1)).alias("n"))


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    fields = ["product_name", "brand", "product", "description", "unit", "quantity"]
    read = read_listings(table(spark, folder, "enriched_offers", "source_row_index", *fields), "source_row_index", *fields)
    return same_product_pairs(product_groups(read)).toDF("source_row_index_a", "source_row_index_b")


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    offers = table(spark, folder, "offers", "offer_key", "ord", "origin", "price_per_kg", "extraction_confidence", "extracted_at")
    fields = {"origin": usable_origin(offers.origin), "price_per_kg": usable_price(offers.price_per_kg)}
    return survivors(offers, "offer_key", "ord", fields, offers.extraction_confidence, offers.extracted_at).drop("value")


def p6_supported(spark: SparkSession, folder: str) -> DataFrame:
    """The values themselves, voted by the confidence that stands behind each."""
    offers = table(spark, folder, "offers", "offer_key", "ord", "origin", "price_per_kg", "extraction_confidence", "extracted_at")
    fields = {"origin": usable_origin(offers.origin), "price_per_kg": usable_price(offers.price_per_kg)}
    return survivors(offers, "offer_key", "ord", fields, offers.extraction_confidence, offers.extracted_at, weights="support")


def p6_unknown(spark: SparkSession, folder: str) -> DataFrame:
    """Origins that are taken for none though they don't only fill the field, with their rows."""
    o = table(spark, folder, "offers", "origin")
    return o.groupBy(unknown_origin(o.origin).alias("origin")).agg(F.count(F.lit(1)).alias("n")).where("origin is not null")


def p7_ids(spark: SparkSession, folder: str) -> DataFrame:
    return corpus_ids(table(spark, folder, "documents", "doc_id", "text"), "doc_id", "text")


def p8_found(spark: SparkSession, folder: str) -> DataFrame:
    return leaks(table(spark, folder, "documents", "doc_id", "text"), "doc_id", "text", table(spark, folder, "bench_items", "item_id", "text"), "item_id", "text")


def p8_edited(spark: SparkSession, folder: str) -> DataFrame:
    """All passages within the budget of edits, the exact ones among them."""
    return passages(table(spark, folder, "documents", "doc_id", "text"), "doc_id", "text", table(spark, folder, "bench_items", "item_id", "text"), "item_id", "text")


def p9_scores(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents", "doc_id", "text", "source")
    scorer = abuse.train(docs, "doc_id", "text", table(spark, folder, "doc_reviews", "doc_id", "label"), "doc_id", "label")
    return abuse.scores(docs, "doc_id", "text", scorer, "source")


def p9_found(spark: SparkSession, folder: str) -> DataFrame:
    return p9_scores(spark, folder).where(F.col("score") >= abuse.THRESHOLD).select("doc_id").distinct()


def p9_rates(spark: SparkSession, folder: str) -> DataFrame:
    """Documents and the share that is abusive, by source."""
    hit = F.sum((F.col("score") >= abuse.THRESHOLD).cast("long"))
    return p9_scores(spark, folder).groupBy("source").agg(F.count(F.lit(1)).alias("documents"), hit.alias("abusive"), F.round(hit / F.count(F.lit(1)), 4).alias("rate"))


QUERIES = {"p2_found": p2_found, "p3_found": p3_found, "p3_ways": p3_ways, "p4_found": p4_found, "p6_found": p6_found, "p6_supported": p6_supported, "p6_unknown": p6_unknown, "p7_ids": p7_ids, "p8_found": p8_found, "p8_edited": p8_edited, "p9_found": p9_found, "p9_rates": p9_rates}



def _folded_sql(text: str) -> str:
    """leaks.folded_words in SQL."""
    mended = text
    for c in MISREAD:
        for way in ("latin-1", "cp1252"):
            if len(broken := c.encode().decode(way, "ignore")) == 2:
                mended = f"replace({mended}, '{broken}', '{c}')"
    s = f"lower(CASE WHEN contains({text}, 'Ã') THEN {mended} ELSE {text} END)"
    s = rf"regexp_replace({s}, '[\x{{ad}}\x{{300}}-\x{{36f}}\x{{200b}}-\x{{200f}}\x{{2060}}\x{{feff}}]|[-\x{{2010}}\x{{2011}}][ \t\x{{a0}}]*(?:\r\n|[\n\x0b\f\r\x{{85}}\x{{2028}}\x{{2029}}])[ \t\n\x0b\f\r]*', '', 'g')"
    s = f"regexp_replace(translate(replace({s}, 'ß', 'ss'), '{MARKED}', '{PLAIN}'), '([aou])e', '\\1', 'g')"
    return f"trim(regexp_replace({s}, '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'))"


SQL = {
    "p8_found": f"""
WITH i AS (SELECT item_id, string_split({_folded_sql('text')}, ' ') AS w FROM bench_items),
d AS (SELECT doc_id, string_split({_folded_sql('text')}, ' ') AS w FROM documents WHERE text IS NOT NULL),
iw AS (SELECT DISTINCT item_id, array_to_string(w[k:k + 14], ' ') AS run FROM (SELECT item_id, w, unnest(range(1, len(w) - 13)) AS k FROM i)),
dw AS (SELECT doc_id, array_to_string(w[k:k + 14], ' ') AS run FROM (SELECT doc_id, w, unnest(range(1, len(w) - 13)) AS k FROM d))
SELECT DISTINCT doc_id, item_id FROM dw JOIN iw USING (run)""",
    "p2_found": """
WITH RECURSIVE e AS (
  SELECT DISTINCT lower(trim(product_id_a)) AS a, lower(trim(product_id_b)) AS b FROM pair_decisions
  WHERE decision IN ('exact_match', 'close_comparable') AND trim(product_id_a) <> '' AND trim(product_id_b) <> ''
    AND lower(trim(product_id_a)) <> lower(trim(product_id_b))),
n AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
r AS (SELECT a AS id, a AS root FROM n UNION SELECT n.b, r.root FROM r JOIN n ON n.a = r.id WHERE r.root < n.b OR r.root < r.id)
SELECT id AS product_id, min(root) AS group_id FROM r GROUP BY id
""",
    "p6_unknown": f"""
SELECT trim(origin) AS origin, count(*) AS n FROM offers
WHERE origin IS NOT NULL AND NOT regexp_matches(lower(trim(origin)), '{NAMES_COUNTRY}') AND lower(trim(origin)) NOT IN {FILL_IN_ORIGINS} GROUP BY 1""",
    "p6_found": f"""
WITH r AS (
  SELECT offer_key, ord, extracted_at AS t, CAST(round(CASE WHEN extraction_confidence <= 1 THEN extraction_confidence * 100 ELSE extraction_confidence END) AS INT) AS c,
         count(*) OVER (PARTITION BY offer_key) AS n, trim(coalesce(origin, '')) AS origin, price_per_kg AS p FROM offers),
v AS (
  SELECT offer_key, 'origin' AS field, ord, c, t FROM r WHERE n > 1 AND regexp_matches(lower(origin), '{NAMES_COUNTRY}')
  UNION ALL
  SELECT offer_key, 'price_per_kg', ord, c, t FROM r WHERE n > 1 AND p > 0 AND NOT isnan(p) AND p NOT IN (9999.0, 99999.99))
SELECT offer_key, field, ord FROM v QUALIFY row_number() OVER (PARTITION BY offer_key, field ORDER BY c DESC, t DESC, ord DESC) = 1
""",
}
