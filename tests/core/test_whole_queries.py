"""Queries over small tables that show what a narrower selection leaves out."""

import math

import __spark_entry__ as entry


def test_tfidf_counts_listings_without_brand(spark, tmp_path):
    names = {0: "roter lachs", 1: "roter lachs filet", 2: "roter kabeljau", 50: "lachs filet"}
    rows = [(i, name, "Nordsee" if i == 2 else ("" if i else None)) for i, name in names.items()]
    spark.createDataFrame(rows, "source_row_index bigint, product_name string, brand string").write.parquet(f"{tmp_path}/enriched_offers.parquet")
    tf = {i: n.split() + [f"{a} {b}" for a, b in zip(n.split(), n.split()[1:], strict=False)] for i, n in names.items()}
    idf = {t: math.log((1 + len(tf)) / (1 + sum(t in x for x in tf.values()))) + 1 for x in tf.values() for t in x}
    norm = {i: math.sqrt(sum(idf[t] ** 2 for t in x)) for i, x in tf.items()}
    want = {(q, d, round(sum(idf[t] ** 2 for t in tf[q] if t in tf[d]) / norm[q] / norm[d], 4)) for q in (0, 50) for d in tf if d != q and set(tf[q]) & set(tf[d])}
    got = entry.queries()["tfidf_top_k"](spark, str(tmp_path)).collect()
    assert {(r["query"], r["source_row_index"], r["similarity"]) for r in got} == want
