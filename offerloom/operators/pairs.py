"""Similarity joins of texts by their TF-IDF vectors, exact, by prefix filtering."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def prefixes(vectors: DataFrame, doc: str, least: float) -> DataFrame:
    """doc, term: each document's rarest terms, as many as needed for the rest to weigh less than least together.

    Of two unit vectors with a product of at least least, each must have a term of its prefix in the other's: the rest of
    a vector contributes at most its own length. Terms are ordered by their document frequency, then by themselves.
    """
    df = vectors.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    w = Window.partitionBy(doc).orderBy(F.col("df").desc(), F.col("term").desc()).rowsBetween(Window.unboundedPreceding, 0)
    return vectors.join(df, "term").withColumn("rest", F.sqrt(F.sum(F.col("weight") * F.col("weight")).over(w))).where(F.col("rest") >= least - 1e-6).select(doc, "term")


def similar_pairs(vectors: DataFrame, doc: str, least: float, group: str | None = None, same: bool = True) -> DataFrame:
    """a, b, similarity: pairs of documents (a < b) with a cosine of at least least (rounded to four decimals).

    vectors has doc, term, weight (unit length), and the group column if one is named: then only pairs of the same group
    (or, with same false, of two different ones) count. Candidates share a prefix term; equal vectors should be one
    document by then, as they meet in all pairs.
    """
    head = prefixes(vectors, doc, least)
    if group:
        head = head.join(vectors.select(doc, group).distinct(), doc)
    a = head.select("term", F.col(doc).alias("a"), *([F.col(group).alias("ga")] if group else []))
    b = head.select("term", F.col(doc).alias("b"), *([F.col(group).alias("gb")] if group else []))
    fits: Column = F.col("a") < F.col("b")
    if group:
        fits = fits & ((F.col("ga") == F.col("gb")) if same else (F.col("ga") != F.col("gb")))
    candidates = a.join(b, "term").where(fits).select("a", "b").distinct()
    left, right = vectors.select(F.col(doc).alias("a"), "term", F.col("weight").alias("x")), vectors.select(F.col(doc).alias("b"), "term", F.col("weight").alias("y"))
    product = candidates.join(left, "a").join(right, ["b", "term"]).groupBy("a", "b").agg(F.round(F.sum(F.col("x") * F.col("y")), 4).alias("similarity"))
    return product.where(F.col("similarity") >= least)
