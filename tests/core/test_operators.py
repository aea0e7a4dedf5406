import random

from pyspark.sql import functions as F

import offerloom.operators.joins as joins
from offerloom.operators.documents import failed_keys, first_by_content, greedy_distinct, log_events
from offerloom.operators.graph import clusters
from offerloom.operators.joins import containment_join, fuzzy_best, token_sort_ratio, upserted, with_marks
from offerloom.operators.ranking import interleaved, last_until_sure, mode_first_seen, winner
from offerloom.operators.similarity import dense_neighbours


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_ranking(spark):
    df = spark.createDataFrame([("a", "x", 1, 0.5), ("a", "y", 2, 1.0), ("a", "y", 3, 1.0), ("a", "x", 4, 0.2), ("b", None, 5, 0.1), ("b", "", 6, None)], "g string, v string, o bigint, c double")
    assert rows(winner(df, ["g"], [F.col("c"), -F.col("o")])) == [("a", "y", 2, 1.0), ("b", None, 5, 0.1)]
    assert rows(mode_first_seen(df, ["g"], "v", "o")) == [("a", "x", 2)]
    assert rows(last_until_sure(df, ["g"], "o", "o", F.col("c") >= 1)) == [("a", 2, 4), ("b", 6, 2)]
    order = [r["o"] for r in interleaved(df, "g", [F.col("o")], F.col("g")).collect()]
    assert order == [1, 5, 2, 6, 3, 4]
    assert rows(winner(df.limit(0), ["g"], [F.col("c")])) == []


def test_joins(spark):
    t = spark.createDataFrame([("frischer lachs",), ("lachs",), ("",), (None,), ("tofu",)], "t string")
    k = spark.createDataFrame([("lachs", "L"), ("frischer lachs filet", "F"), ("", "none")], "k string, v string")
    assert rows(containment_join(t, "t", k, "k", "v")) == [("frischer lachs", "F"), ("lachs", "F")]
    assert token_sort_ratio("rot paprika", "paprika rot") == 100.0 and token_sort_ratio("", "") == 100.0 and token_sort_ratio("a", "b") == 0.0
    assert [r[1] for r in fuzzy_best(t, "t", ["lachs frischer", "toffu"]).orderBy("t").collect()] == ["lachs frischer", "toffu"]
    marks = spark.createDataFrame([("lachs", 3)], "t string, n int")
    assert {r["t"]: r["n"] for r in with_marks(t, marks, "t", {"n": F.lit(0)}).collect()} == {"frischer lachs": 0, "lachs": 3, "": 0, None: 0, "tofu": 0}
    old = spark.createDataFrame([("a", "x"), ("b", "y")], "k string, c string")
    new = spark.createDataFrame([("b", ""), ("c", "z"), ("a", "w")], "k string, c string")
    assert rows(upserted(old, new, "k", ["c"], new.c == "")) == [("a", "w"), ("c", "z")]


def test_clusters(spark):
    rng = random.Random(1)
    edges = [(f"n{a:03}", f"n{b:03}") for a, b in ((rng.randint(0, 150), rng.randint(0, 150)) for _ in range(90))] + [(f"p{i:03}", f"p{i + 1:03}") for i in range(60)] + [("q", "q"), (None, "z")]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if a and b and a != b:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    want = sorted((v, find(v)) for v in root)
    assert rows(clusters(spark.createDataFrame(edges, "a string, b string"), "a", "b")) == want


def test_hot_keys_are_dealt(spark, monkeypatch):
    monkeypatch.setattr(joins, "HOT_ROWS", 10)
    edges = [("hub", f"s{i:03}") for i in range(70)] + [(f"p{i:03}", f"p{i + 1:03}") for i in range(40)] + [("x", "y")]
    got = dict(rows(clusters(spark.createDataFrame(edges, "a string, b string"), "a", "b")))
    assert {got[f"s{i:03}"] for i in range(70)} == {"hub"} and {got[f"p{i:03}"] for i in range(41)} == {"p000"} and got["y"] == "x" and len(got) == 114
    df = spark.createDataFrame([("h", i) for i in range(95)] + [("c", 0)], "k string, v int")
    hot = joins.hot_keys(df, "k")
    assert rows(hot) == [("h", 10)]
    out = joins.looked_up(df, "k", spark.createDataFrame([("h", 1), ("c", 2), ("z", 3)], "k string, n int"), hot, "v")
    assert out.columns == ["k", "v", "n"] and rows(out) == sorted([("h", i, 1) for i in range(95)] + [("c", 0, 2)])


def test_documents(spark):
    d = spark.createDataFrame([(1, "a"), (2, None), (3, "a"), (4, "2026-01-01 ERROR extract metro/2026/29 seite_032 failed after 1 attempts\n{\"timestamp\": \"t\", \"level\": \"INFO\", \"duration_ms\": 5}\n{broken")], "i bigint, t string")
    assert [(r["i"], r["copies"]) for r in first_by_content(d, "i", "t").orderBy("i").collect()] == [(1, 2), (4, 1)]
    assert rows(failed_keys(d, "t")) == [("metro", 2026, 29, "seite_032", 1)]
    assert [(r["level"], r["duration_ms"]) for r in log_events(d, "t").collect()] == [("INFO", 5)]
    u = spark.createDataFrame([("g", 1, "u1", "t1"), ("g", 2, "u1", "t2"), ("g", 3, "u2", "t2"), ("g", 4, None, None), ("g", 5, None, "t1"), ("h", 6, "u1", "t1")], "g string, o int, u string, t string")
    assert [r["o"] for r in greedy_distinct(u, "g", "o", ["u", "t"]).orderBy("o").collect()] == [1, 3, 4, 6]


def test_dense(spark):
    v = spark.createDataFrame([(i, [float(i % 3), 1.0]) for i in range(9)] + [(9, None)], "k bigint, v array<double>")
    got = {(r["query"], r["rank"]): (r["k"], r["similarity"]) for r in dense_neighbours(spark, v, "k", "v", F.col("key") == 0, 2).collect()}
    assert got == {(0, 1): (3, 1.0), (0, 2): (6, 1.0)}


def test_long_keyword_lists_join_on_equal_strings(spark, monkeypatch):
    rng = random.Random(7)
    word = lambda n: "".join(rng.choice("abc ") for _ in range(rng.randint(1, n))).strip()
    t = spark.createDataFrame([(word(9),) for _ in range(80)] + [(None,)], "t string")
    k = spark.createDataFrame([(word(5), f"v{i % 7}") for i in range(40)], "k string, v string")
    want = rows(containment_join(t, "t", k, "k", "v"))
    monkeypatch.setattr(joins, "LIST_LIMIT", 3)
    assert rows(containment_join(t, "t", k, "k", "v")) == want and len(want) > 20


def test_closest_name_as_by_trying_all():
    rng = random.Random(8)
    names = [" ".join("".join(rng.choice("abcd") for _ in range(rng.randint(1, 5))) for _ in range(rng.randint(1, 3))) for _ in range(60)]
    index = joins.NameIndex(names)
    for _ in range(300):
        t = rng.choice(names) + rng.choice(["", "a", " b", "c"])
        for least in (60.0, 80.0):
            top = max(((token_sort_ratio(t, n), -i, n) for i, n in enumerate(names)), key=lambda x: (x[0], x[1]))
            assert index.best(t, least) == (top if top[0] >= least else (0.0, 0, None))


def test_dense_over_batches_and_blocks(spark, monkeypatch):
    import offerloom.operators.similarity as similarity

    monkeypatch.setattr(similarity, "BLOCK", 3)
    rng = random.Random(6)
    data = [(i, [rng.choice([-1.0, 0.0, 1.0]) for _ in range(4)]) for i in range(120)]
    size = {i: sum(x * x for x in v) ** 0.5 for i, v in data}
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        got = {(r["query"], r["rank"]): (r["k"], r["similarity"]) for r in dense_neighbours(spark, spark.createDataFrame(data, "k bigint, v array<double>"), "k", "v", F.col("key") % 10 == 0, 5).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    for q, v in data[::10]:
        sims = sorted((-round(sum(a * b for a, b in zip(v, w, strict=True)) / (size[q] * size[i]) if size[q] and size[i] else 0.0, 6) + 0.0, i) for i, w in data if i != q)[:5]
        assert [got[q, n + 1] for n in range(5)] == [(i, -s) for s, i in sims]
