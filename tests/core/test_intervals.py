import datetime as dt
import random

from offerloom.operators.intervals import periods_and_gaps

DAY = dt.date(2024, 1, 1)
SCHEMA = "who string, what string, a date, b date, kind string, s bigint"


def brute(rows):
    out = set()
    by = {}
    for who, what, a, b, *_ in rows:
        if None not in (who, what, a, b) and a <= b:
            by.setdefault((who, what), set()).update(a + dt.timedelta(i) for i in range((b - a).days + 1))
    for k, days in by.items():
        days, start, last = sorted(days), None, None
        for d in days:
            if last is None or (d - last).days > 1:
                if last is not None:
                    out.add((*k, "period", str(start), str(last)))
                    out.add((*k, "gap", str(last + dt.timedelta(1)), str(d - dt.timedelta(1))))
                start = d
            last = d
        out.add((*k, "period", str(start), str(last)))
    return out


def test_against_days(spark):
    rng = random.Random(3)
    rows = []
    for _ in range(300):
        a = DAY + dt.timedelta(rng.randint(-400, 400) if rng.random() < 0.1 else rng.randint(0, 150))
        b = a + dt.timedelta(rng.choice([0, 0, 1, 2, 6, 6, 13, 40, -3]))
        rows.append((rng.choice(["x", "y", None]), rng.choice(["t", "u"]), rng.choice([a, a, a, None]), b, "k", 1))
    rows += rows[:20]
    df = spark.createDataFrame(rows, SCHEMA)
    got = [tuple(r) for r in periods_and_gaps(df, ["who", "what"], "a", "b").collect()]
    assert len(got) == len(set(got)) and set(got) == brute(rows)


def test_hot_entity_old_and_long_spans(spark):
    rows = [("h", "t", DAY + dt.timedelta(i % 97 * 3), DAY + dt.timedelta(i % 97 * 3 + i % 2), "", 0) for i in range(4000)]
    rows += [("o", "t", dt.date(1969, 12, 30), dt.date(1970, 1, 2), "", 0), ("o", "t", dt.date(1900, 1, 1), dt.date(1969, 12, 29), "", 0), ("o", "t", dt.date(2100, 1, 1), dt.date(2100, 1, 1), "", 0)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert {tuple(r) for r in periods_and_gaps(df, ["who", "what"], "a", "b").collect()} == brute(rows)


def test_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    out = periods_and_gaps(df, ["who", "what"], "a", "b")
    assert out.columns == ["who", "what", "kind", "start_date", "end_date"] and out.count() == 0
