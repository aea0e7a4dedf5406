import __spark_entry__ as entry


def test_whole_titles(spark, tmp_path):
    rows = [(1, "Spargel Steinfurt-Ost"), (2, "spargel  nordtal"), (3, "KW 46"), (4, "über größe"), (5, ""), (6, None)]
    spark.createDataFrame(rows, "doc_id bigint, title string").write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(tuple(r) for r in entry.queries()["title_slugs"](spark, str(tmp_path)).collect())
    assert got == [(1, "Spargel Steinfurt-Ost", "spargel_steinfurt_ost"), (2, "Spargel  Nordtal", "spargel_nordtal"), (3, "KW 46", "kw_46"), (4, "Über Größe", "ueber_groesse")]
