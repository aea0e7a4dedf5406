import datetime as dt
import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import offerloom.operators.units as units
from offerloom.operators.changepoints import levels, segments
from offerloom.operators.units import common_units, read_content, read_unit

SCHEMA = "ord bigint, product_name string, description string, unit string, quantity double, price double, price_per_kg double, supplier string, source_title string, extracted_at timestamp, row string, base string"
AT = dt.datetime(2025, 3, 1)


def run(spark, rows):
    full = [(i, n, d, u, q, p, k, "metro", "t", AT + dt.timedelta(minutes=i), "r", "b") for i, (n, d, u, q, p, k) in enumerate(rows)]
    return {r["ord"]: (r["base_unit"], r["base_amount"], r["cent_per_unit"]) for r in common_units(spark.createDataFrame(full, SCHEMA)).collect()}


CASES = [
    (("Lachs", None, " kg", 2.5, 10.0, None), ("g", 2500, 400)),
    (("Lachs", None, "kg", None, 7.99, 7.99), ("g", 1000, 799)),
    (("Lachs", None, "je 100g", 2.0, 4.28, None), ("g", 200, 2140)),
    (("Lachs", None, "Pfd.", 3.0, 15.0, None), ("g", 1500, 1000)),
    (("Öl", None, "Ltr.", 2.0, 5.0, None), ("ml", 2000, 250)),
    (("Öl - 3 Stück à 25cl", "Sortierung 26/30", "Tetra", 1.0, 8.99, 11.99), ("ml", 750, 1199)),
    (("Lachs 6 x 800 g", "Art. 48068", "Kiste", 2.0, 96.0, None), ("g", 9600, 1000)),
    (("Lachs", "2er Pack je 1,5 kg", "Karton", None, 30.0, None), ("g", 3000, 1000)),
    (("Lachs", "Inhalt: 3.000 g", "KTN", 1.0, 30.0, None), ("g", 3000, 1000)),
    (("Lachs 3,5-kg-Schale", "Kal. 4/6", "Sch.", 1.0, 35.0, None), ("g", 3500, 1000)),
    (("Gurken", "Stücke 180-220 g", "Stk", 10.0, 20.34, None), ("stueck", 10, 203)),
    (("Gurken", "mit 8 Stück", "Karton", 2.0, 16.0, None), ("stueck", 16, 100)),
    (("Lachs 2-kg", None, "kg", 2000.0, 20.0, 10.0), ("g", 2000, 1000)),
    (("Lachs", None, "kg", 2.0, 2000.0, 10.0), ("g", 2000, 1000)),
    (("Lachs", None, "kg", 6.0, 25.39, 2.115), ("g", 6000, 423)),
    (("Lachs", None, "kg", 2.5, 41.78, 1671.0), ("g", 2500, 1671)),
    (("x" * 200_000 + " 500 g", "", "Beutel", 1.0, 5.0, None), ("g", 500, 1000)),
]
NONE = [("Lachs", "Ø 15+", "Eimer", 1.0, 5.0, None), (None, None, None, None, None, None), ("", "", "", 1.0, 5.0, None), ("Lachs", None, "kg", 0.0, 5.0, None), ("Lachs", None, "kg", 1.0, float("nan"), None), ("Lachs", None, "kg", -2.0, 5.0, None)]


def test_cases(spark):
    got = run(spark, [c[0] for c in CASES] + NONE)
    assert [got.get(i) for i in range(len(CASES))] == [c[1] for c in CASES]
    assert not {i for i in got if i >= len(CASES)}


def test_empty_and_repeated(spark):
    assert run(spark, []) == {}
    df = spark.createDataFrame([(1, "Lachs", None, "kg", 1.0, 5.0, None, None, None, None, "r", "b")] * 3, SCHEMA)
    assert common_units(df).count() == 3


def test_hot_source_over_blocks(spark):
    rows = [("Lachs", None, "kg", 1.0, 1000.0 if i % 50 == 0 else 10.0, 10.0) for i in range(9000)]
    got = run(spark, rows)
    assert len(got) == 9000 and {v[2] for v in got.values()} == {1000}


@pytest.mark.parametrize("seed", range(8))
def test_changepoints_are_exact(seed):
    rng = random.Random(seed)
    x = np.array([rng.choice([0.0, 0.0, 4.6]) + rng.gauss(0, 0.2) for _ in range(9)])

    def cost(ends):
        parts = [x[a:b] for a, b in zip([0, *ends], [*ends, len(x)], strict=True)]
        return sum(((p - p.mean()) ** 2).sum() for p in parts) + len(ends)

    best = min(cost(c) for n in range(len(x)) for c in itertools.combinations(range(1, len(x)), n))
    assert cost(segments(x, 1.0)[:-1]) == pytest.approx(best)
    assert len(levels(x, 1.0)) == len(x)


def test_readers():
    assert read_unit(" 100 Gramm ") == ("g", 100.0) and read_unit("St.") == ("stueck", 1.0) and read_unit("Kiste")[0] is None and read_unit(None)[0] is None
    assert read_content("12 stück à 0,25 kg") == ("g", 3000.0) and read_content("1.500 g") == ("g", 1500.0) and read_content("5.00 kg") == ("g", 5000.0) and read_content("") == (None, 0.0)


def shifted(n, first, last):
    """kg offers of 2 kg for 20.00, at 10.00 a kilo, in grams from first to before last; every third states nothing else."""
    out = []
    for i in range(n):
        q = 2000.0 if first <= i < last else 2.0
        out.append(("Lachs", None, "kg", q, 20.0, None) if i % 3 == 1 else ("Lachs 2 kg", None, "kg", q, 20.0, 10.0))
    return out


def test_segments_decide_on_rows_without_evidence(spark):
    got = run(spark, shifted(120, 42, 70))
    assert set(got.values()) == {("g", 2000, 1000)}
    # A lone value on another scale decides on itself only.
    lone = run(spark, shifted(60, 30, 31))
    assert set(lone.values()) == {("g", 2000, 1000)}
    few = [*shifted(12, 0, 0), ("Lachs 2 kg", None, "kg", 2000.0, 20.0, 10.0), ("Lachs", None, "kg", 2000.0, 20.0, None), ("Lachs 2 kg", None, "kg", 2000.0, 20.0, 10.0), *shifted(12, 0, 0)]
    assert run(spark, few)[13] == ("g", 2_000_000, 1)


def test_rows_of_the_true_size_stay_within_a_shifted_segment(spark):
    rows = [("Lachs 2 kg", None, "kg", 2000.0, 20.0, 10.0)] * 6 + [("Lachs", None, "kg", 4.0, 40.0, None), ("Lachs", None, "kg", 3000.0, 30.0, None)] + [("Lachs 2 kg", None, "kg", 2000.0, 20.0, 10.0)] * 6
    got = run(spark, rows)
    assert got[6] == ("g", 4000, 1000) and got[7] == ("g", 3000, 1000) and {got[i] for i in range(14) if i not in (6, 7)} == {("g", 2000, 1000)}


def test_prices_in_cents_for_a_while(spark):
    rows = [("Lachs", None, "kg", 2.0, 2000.0 if 30 <= i < 60 else 20.0, None if i % 4 == 1 else 10.0) for i in range(90)]
    assert set(run(spark, rows).values()) == {("g", 2000, 1000)}


def test_small_gram_values(spark):
    assert run(spark, [("Vanille 20 g", None, "kg", 20.0, 5.0, None)])[0] == ("g", 20, 25000)


def test_a_hot_source_is_sliced_with_overlap(spark, monkeypatch):
    monkeypatch.setattr(units, "BLOCK", 64)
    rows = shifted(1000, 300, 679)
    full = [(i, n, d, u, q, p, k, "metro", "t", AT + dt.timedelta(minutes=i), "r", "b") for i, (n, d, u, q, p, k) in enumerate(rows)]
    df = spark.createDataFrame(full, SCHEMA)
    parts = units.sliced(df, units.found_texts(df, "ord"))
    sizes = [r["count"] for r in parts.groupBy("source", "slice").count().collect()]
    assert len(sizes) == 16 and max(sizes) < 100 and parts.where("own").count() == 1000 and parts.count() > 1000
    out = common_units(df).collect()
    assert len(out) == 1000 and {(r["base_unit"], r["base_amount"], r["cent_per_unit"]) for r in out} == {("g", 2000, 1000)}


def test_many_rows_at_one_time_stream(spark, monkeypatch):
    monkeypatch.setattr(units, "BLOCK", 16)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 50)
    try:
        df = spark.createDataFrame([(i, n, d, u, q, p, k, "metro", "t", AT, "r", "b") for i, (n, d, u, q, p, k) in enumerate(shifted(900, 200, 420))], SCHEMA)
        out = common_units(df).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(out) == 900 and {r["base_amount"] for r in out} == {2000}


def test_units_as_expressions(spark):
    texts = [" 100 Gramm ", "St.", "Kiste", None, "", "je 100g", "Pfd.", "pro kg", "KG", "2 L", "Bund", "/ ml", "t", "3 Stück", "kg kg"]
    got = spark.createDataFrame([(t,) for t in texts], "u string").select("u", units.unit_reading(F.col("u")).alias("r")).select("u", "r.*").collect()
    assert [(r["base"], r["factor"]) for r in got] == [(b, f if b else None) for b, f in map(read_unit, texts)]
