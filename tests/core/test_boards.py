import itertools
import math
import random
from collections import Counter

from pyspark.sql import functions as F

from offerloom.functions import arrays, dates, text
from offerloom.operators.folds import blocks_after_heading, last_each
from offerloom.operators.joins import cached_or_new, repaired, resolved
from offerloom.operators.pairs import similar_pairs
from offerloom.operators.similarity import tfidf
from offerloom.sources.files import append_lines, existing, json_ld_offers, latest, read_keyed_lines, replace_atomically


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def cosines(texts):
    grams = []
    for t in texts:
        w = [x for x in t.split() if len(x) > 1]
        grams.append(Counter(w + [f"{a} {b}" for a, b in itertools.pairwise(w)]))
    df = Counter(g for c in grams for g in c)
    vectors = []
    for c in grams:
        v = {g: n * (math.log((1 + len(texts)) / (1 + df[g])) + 1) for g, n in c.items()}
        size = math.sqrt(sum(x * x for x in v.values()))
        vectors.append({g: x / size for g, x in v.items()})
    return {(i, j): round(sum(x * vectors[j].get(g, 0.0) for g, x in vectors[i].items()), 4) for i, j in itertools.combinations(range(len(texts)), 2)}


def test_similar_pairs_against_all(spark):
    rng = random.Random(3)
    texts = [" ".join(rng.choice(["lachs", "filet", "frisch", "natur", "butter", "rot", "kilo", "bio"]) for _ in range(rng.randint(1, 4))) for _ in range(60)]
    df = spark.createDataFrame([(i, t, "ab"[i % 2]) for i, t in enumerate(texts)], "d bigint, t string, s string")
    v = tfidf(df, "d", F.col("t"))
    every = cosines(texts)
    for least in (0.5, 0.82):
        want = {k for k, s in every.items() if s >= least}
        got = {(r["a"], r["b"]) for r in similar_pairs(v, "d", least).collect()}
        assert {k for k in want ^ got if abs(every[k] - least) > 1e-3} == set() and want
    same = {(r["a"], r["b"]) for r in similar_pairs(v.join(df.select("d", "s"), "d"), "d", 0.6, "s").collect()}
    other = {(r["a"], r["b"]) for r in similar_pairs(v.join(df.select("d", "s"), "d"), "d", 0.6, "s", same=False).collect()}
    assert same and other and all((a - b) % 2 == 0 for a, b in same) and all((a - b) % 2 for a, b in other)
    assert similar_pairs(v.limit(0), "d", 0.5).count() == 0


def test_folds(spark):
    d = spark.createDataFrame([(1, "vor\n# A\nx\n\nPreise:\nyy\nz"), (2, None), (3, ""), (4, "nichts")], "d int, t string")
    assert rows(blocks_after_heading(d, "d", "t")) == [(1, 1, "# A", 1, 1), (1, 2, "Preise:", 2, 3)]
    e = spark.createDataFrame([("a", 1, "x"), ("a", 3, "y"), ("b", None, "z")], "g string, o int, v string")
    assert rows(last_each(e, ["g"], [F.col("o")], ["v"])) == [("a", "y"), ("b", "z")]


def test_caches_and_repairs(spark):
    want = spark.createDataFrame([("a", 0.9), ("b", 0.1)], "k string, s double")
    had = spark.createDataFrame([("a", "no")], "k string, d string")
    assert rows(cached_or_new(want, had, ["k"], "d", F.when(F.col("s") > 0.5, "yes").otherwise("none"))) == [("a", 0.9, "no", True), ("b", 0.1, "none", False)]
    old = spark.createDataFrame([("f1", 1), ("f2", 2), (None, 3)], "f string, n int")
    again = spark.createDataFrame([("f1", 9), ("f1", 8)], "f string, n int")
    assert rows(repaired(old, again, "f")) == sorted([("f1", 9), ("f1", 8), ("f2", 2), (None, 3)], key=repr)
    there = spark.createDataFrame([("a", 4)], "k string, n bigint")
    assert rows(resolved(want.select("k"), there, ["k"], "n")) == [("a", 4, True), ("b", 0, False)]


def test_files(spark, tmp_path):
    path = f"{tmp_path}/lines"
    for n in (1, 2):
        append_lines(spark.createDataFrame([("a", n)], "k string, n int"), path)
    assert spark.read.json(path).count() == 2 and read_keyed_lines(spark, path, "k", "k string, n int").count() == 1
    at = f"{tmp_path}/table"
    replace_atomically(spark.range(3), at)
    replace_atomically(spark.read.parquet(at).where("id > 0"), at)
    assert rows(spark.read.parquet(at)) == [(1,), (2,)] and existing(spark, f"{tmp_path}/none", at) == at and existing(spark, f"{tmp_path}/none") is None
    listing = spark.createDataFrame([("b", 1), ("a", 2), ("c", 2)], "path string, modificationTime int")
    assert latest(listing).first()[0] == "c"
    page = '<script type="application/ld+json">[{"@type": "Offer", "price": "3,50", "priceCurrency": "EUR", "itemOffered": {"name": "Lachs"}}, {"@type": "Product", "name": "Aal", "offers": [{"price": 2}]}]</script>'
    assert rows(json_ld_offers(spark.createDataFrame([(1, page), (2, None)], "p int, t string"), "p", "t")) == [(1, "Aal", 2.0, None), (1, "Lachs", 3.5, "EUR")]


def test_scalars(spark):
    one = lambda c: spark.range(1).select(c).first()[0]
    assert tuple(one(text.verdict(F.lit("Antwort: NEIN, weil es  nicht passt")))) == ("Nein", "weil es") and one(text.verdict(F.lit("vielleicht")))["verdict"] is None
    assert one(text.signal(F.lit("• = Preise  steigen; mehr\nzwei"))) == "± Preise steigen" and one(text.signal(F.lit(None).cast("string"))) is None
    assert one(text.looks_english(F.lit("The fish"))) is False and one(text.looks_english(F.lit("the price of fish is up"))) is True and one(text.looks_english(F.lit(None).cast("string"))) is False
    c = one(text.card(F.lit("Aktuell\n01.02. - 28.02.2026\nGastro\n")))
    assert (c["title"], str(c["start"]), str(c["end"])) == ("Gastro", "2026-02-01", "2026-02-28") and one(text.card(F.lit("31.02. - 01.03.2026")))["start"] is None
    assert one(text.category_label(F.lit("obst_gemuese"))) == "Obst & Gemüse" and one(text.category_rank(F.lit("x"))) == 7 and one(text.brochure_title(F.lit("Gastro (Süd) [neu] – KW"))) == "gastro kw"
    assert one(dates.freshness(F.lit("2026-01-01").cast("date"), F.lit("2026-01-20").cast("date"))) == "month"
    d = one(arrays.defaulted(F.struct(F.lit("x").alias("a"), F.lit(None).cast("int").alias("b")), {"a": F.lit("n"), "b": F.lit(0)}, {"a": ["y"]}))
    assert tuple(d) == ("n", 0)
