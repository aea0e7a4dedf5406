import datetime as dt

from pyspark.sql import functions as F

from offerloom.functions import arrays, dates, names, numbers, text


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(f(F.col("v")).alias("x")).first()["x"]


def test_names(spark):
    for spelling, key in (("Metro C+C", "metro"), (" EDEKA-Foodservice", "edeka"), ("handelshof Köln-Süd", "handelshof"), ("Selgros Cash&Carry", "selgros"), ("Metropol", "metropol"), (None, None)):
        assert one(spark, spelling, names.supplier_key) == key
    assert one(spark, "  Grill \t Saison\n", names.squeeze) == "grill saison"


def test_text(spark):
    for f, value, want in (
        (text.key_text, "Süße-Sahne  20%", "süsse sahne 20"), (text.key_text, None, ""), (text.plain_text, "Österreich!", "osterreich"), (text.slug, "Obst & Gemüse", "obst_gemuese"),
        (text.slug, "!!", "group"), (text.title_words, "DELIKATESS-sahne 2x", "Delikatess-Sahne 2X"), (text.title_first, "aB cD", "AB CD"), (text.supplier_label, "bei Edeka", "Edeka"),
        (text.supplier_label, "x", "Unknown"), (text.country_codes, "Deutschland / Niederlande", "DE, NL"), (text.country_codes, "Holland", "NL"), (text.country_codes, "de", "DE"),
        (text.country_codes, "Spanien, Italien oder Frankreich", "ES, IT, FR"), (text.country_codes, "Chile+Neuseeland", "CL, NZ"), (text.country_codes, "Mond", "Mond"), (text.country_codes, None, ""),
        (text.url_host, "https://www.Shop.de:80/a?b", "shop.de"), (text.url_host, "kein", None), (text.url_key, " HTTPS://a.de/B/?x=1#y ", "https://a.de/b"),
        (lambda c: text.wrapped(c, 10), "aaaa bbbb cccc dddddddddddd e", "aaaa bbbb\ncccc\ndddddddddddd\ne"), (text.is_yes, " Ja ", True), (text.is_yes, None, False),
    ):
        assert one(spark, value, f) == want, (value, want)
    parts = one(spark, "data/metro/2024/gastro_0000011.pdf", text.file_parts)
    assert tuple(parts) == ("metro", 2024, "gastro", 11) and tuple(one(spark, "x", text.file_parts)) == (None,) * 4
    assert one(spark, "a", lambda c: text.labelled_lines({"Name": c, "Leer": F.lit(" ")})) == "Name: a"
    assert len(one(spark, None, lambda c: text.stable_id(c))) == 18


def test_numbers(spark):
    for value, want in (("1,5", 1.5), (" 2.50 ", 2.5), ("5d", None), ("nan", None), ("", None), (None, None), ("1e3", 1000.0)):
        assert one(spark, value, numbers.parse_decimal) == want
    for value, want in ((1.0, 100), (0.92, 92), (87.0, 87), (None, 0), (float("nan"), 0), (0.925, 92), (250.0, 100)):
        assert one(spark, value, numbers.confidence_percent, "double") == want
    for value, want in ((19.99, "19,99"), (2.5, "2,5"), (4.0, "4"), (1200.0, "1200")):
        assert one(spark, value, numbers.german_number, "double") == want
    assert one(spark, 1.25, numbers.key_number, "double") == "1.2500" and one(spark, None, numbers.key_number, "double") == ""
    assert one(spark, 1234567.0, numbers.compact, "double") == "1.2M" and one(spark, -3.24, numbers.signed_percent, "double") == "-3.2%"
    assert one(spark, "2 x 500 g und 1,5 kg", lambda c: numbers.package_grams(c, F.lit(0.2))) == 1500.0
    assert one(spark, "Gr.", lambda c: numbers.kilos(F.lit(500.0), c)) == 0.5


def test_dates(spark):
    assert one(spark, "2026-05-01T10:00", dates.parse_date) == dt.date(2026, 5, 1) and one(spark, "x", dates.parse_date) is None
    for value in ("2026-05-01 08:30", "2026-05-01", "01.05.2026", "20260501"):
        assert one(spark, value, dates.parse_date_any) == dt.date(2026, 5, 1)
    week = lambda y, w: one(spark, w, lambda c: dates.week_start(F.lit(y), c), "int")
    assert week(2026, 18) == dt.date(2026, 4, 27) and week(2026, 53) == dt.date(2026, 12, 28) and week(2025, 53) is None
    assert one(spark, dt.date(2026, 5, 1), lambda c: dates.valid_through_friday(c, F.lit(2026), F.lit(18)), "date") is True
    assert one(spark, None, lambda c: dates.valid_through_friday(c, F.lit(2026), F.lit(18)), "date") is False
    assert one(spark, dt.date(2026, 6, 1), lambda c: dates.short_range(c, F.lit(None)), "date") == "01.06."


def test_arrays(spark):
    kind = arrays.TIERS
    assert one(spark, [(3.0, 5.0), (1.0, 6.0)], arrays.tier_key, kind) == "1.0000:6.0000;3.0000:5.0000" and one(spark, None, arrays.tier_key, kind) == ""
    assert one(spark, [(4.0, 18.5)], arrays.tier_label, kind) == "ab 4: 18,5 EUR" and one(spark, [], arrays.tier_label, kind) == "unknown"
    assert one(spark, [(1.0, 3.0), (2.0, 2.0), (3.0, 1.0)], arrays.second_or_first, kind)["price"] == 2.0
    assert one(spark, '```json\n{"a": 1}\n```', lambda c: arrays.embedded_json(c, "a int"))["a"] == 1
    assert one(spark, ["A", "b", "a", "B"], lambda c: arrays.distinct_by(c, F.lower), "array<string>") == ["A", "b"]
