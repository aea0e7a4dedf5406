import datetime as dt
import json

from offerloom.sources import files
from offerloom.streaming.offers import append, daily_counts, new_offers, read_stream


def test_csv_round_trip(spark, tmp_path):
    p = tmp_path / "o.csv"
    p.write_text('﻿supplier,product_name,price,price_is_net,quantity,price_tiers,valid_from\nmetro,"Lachs, ""frisch""",,True,"1,5","[{""min_qty"": 4, ""price"": 18.5}]",2026-06-01\nedeka,Käse,3.5,False,None,,x\n', encoding="utf-8")
    s = files.read_strings(spark, str(p), files.OFFER_COLUMNS + files.ADDED_COLUMNS)
    assert set(files.OFFER_COLUMNS + files.ADDED_COLUMNS) <= set(s.columns) and s.first()["brand"] == ""
    a, b = files.typed_offers(s).orderBy("price").collect()
    assert (a["product_name"], a["price"], a["price_is_net"], a["quantity"], a["valid_from"], a["unit"]) == ('Lachs, "frisch"', 0.0, True, 1.5, dt.date(2026, 6, 1), "kg")
    assert a["price_tiers"][0]["price"] == 18.5 and b["quantity"] is None and b["valid_from"] is None and b["extraction_confidence"] == 1.0
    files.write_strings(files.typed_offers(s), str(tmp_path / "out"), "supplier")
    back = files.typed_offers(files.read_strings(spark, str(tmp_path / "out")).replace("true", "True", ["price_is_net"]))
    assert sorted(map(str, back.collect())) == sorted(map(str, files.typed_offers(s).collect()))


def test_lines_and_partitions(spark, tmp_path):
    p = tmp_path / "c.jsonl"
    p.write_text('{"k": "a", "n": 1}\n\nbroken\n{"n": 5}\n{"k": "b", "n": 2}\n{"k": "a", "n": 3}\n')
    assert sorted(tuple(r) for r in files.read_keyed_lines(spark, str(p), "k", "k string, n int").collect()) == [("a", 3), ("b", 2)]
    f = spark.createDataFrame([("d/metro/2026/14/a.pdf",), ("d/metro/2026/14/b.pdf",), ("d/metro/2026/neu/c.pdf",)], "path string")
    assert [tuple(r) for r in files.partitions(spark, f, "path").collect()] == [("metro", 2026, 14, 2)]
    d = spark.createDataFrame([("metro", 2026, 14, 1), ("metro", None, 14, 2)], "supplier string, year int, calendar_week int, n int")
    files.write_partitioned(d, str(tmp_path / "p"))
    files.write_lines(d, str(tmp_path / "l"))
    assert spark.read.parquet(str(tmp_path / "p")).count() == 1 and spark.read.json(str(tmp_path / "l")).count() == 2


def test_embedded(spark):
    config = json.dumps({"headline": "h", "tabs": [{"title": "Aktuell", "entries": [{"title": "A", "validFrom": "2026-01-01"}, {"title": "B"}]}]}).replace('"', "&quot;")
    ld = '<script type="application/ld+json">{"@graph": [{"@type": "Product", "name": "Lachs", "offers": [{"price": "3,5", "priceCurrency": "EUR"}]}]}</script><script type="application/ld+json">{broken</script>'
    cube = json.dumps({"x": [{"qHyperCube": {"qDimensionInfo": [{"qFallbackTitle": "d"}], "qMeasureInfo": [{"qFallbackTitle": "m"}], "qDataPages": [{"qMatrix": [[{"qText": "a"}, {"qNum": 1}]]}]}}]})
    pages = spark.createDataFrame([(1, f'<div class="cmp-brochure-preview" data-config="{config}"></div>{ld}', cube), (2, None, "{"), (3, "", None)], "page bigint, html string, payload string")
    assert [(r["tab"], r["title"], r["validFrom"]) for r in files.preview_entries(pages, "page", "html").collect()] == [("Aktuell", "A", "2026-01-01"), ("Aktuell", "B", None)]
    assert [tuple(r) for r in files.json_ld_offers(pages, "page", "html").collect()] == [(1, "Lachs", 3.5, "EUR")]
    assert sorted(tuple(r) for r in files.hypercube_rows(pages, "page", "payload").collect()) == [(1, 0, "d", "a"), (1, 0, "m", "1")]


def test_stream(spark, tmp_path):
    def put(n, rows):
        spark.createDataFrame(rows, "offer_key string, supplier string, extracted_at timestamp").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))

    put(0, [("a", "Metro", dt.datetime(2026, 1, 1)), ("a", "metro", dt.datetime(2026, 1, 1)), ("b", "edeka", dt.datetime(2026, 1, 2))])
    schema = spark.read.parquet(str(tmp_path / "in")).schema
    go = lambda f, name: append(f(read_stream(spark, str(tmp_path / "in"), schema)), str(tmp_path / name), str(tmp_path / f"{name}.cp")).awaitTermination()
    go(new_offers, "keys")
    put(1, [("b", "edeka", dt.datetime(2026, 1, 3)), ("c", "edeka", dt.datetime(2026, 3, 1))])
    go(new_offers, "keys")
    assert sorted(r["offer_key"] for r in spark.read.parquet(str(tmp_path / "keys")).collect()) == ["a", "b", "c"]
    go(daily_counts, "days")
    assert spark.read.parquet(str(tmp_path / "days")).where("supplier = 'metro'").first()["offers"] == 2
