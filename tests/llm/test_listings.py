import itertools
import random

import offerloom.llm.listings as listings
from offerloom.llm.listings import Phrases, edits, product_groups, read_listing, read_listings, same_product_pairs, understood, without, wordings
from offerloom.session import Scratch

FIELDS = ["product_name", "brand", "product", "description", "unit", "quantity"]
SCHEMA = "source_row_index bigint, " + ", ".join(f"{f} string" for f in FIELDS) + ", row string, id string"
# Invented wordings: the operator knows none of them.
ARTICLES = [("Lorbek", "Tamin aus Sorv"), ("Quisalit", "Salit nach Quis"), ("Perunda", "Rundapaste"), ("Mekolo", "Kolo in Form"), ("Zafir", "Birnzaf"), ("Dumelo", "Melofein")]
VARIANTS = [("blank", "ohne Farbe"), ("dunkel", "dunkle Art"), ("mit Senf", "senfig"), ("Luftig", "aufgeschlagen"), ("Kugelform", "gekugelt")]
ADS = ["Aktion", "jetzt probieren", "für Genießer", "Spar-Tipp", "Neu", "beliebt"]


def corpus(seed, brands, size):
    rng = random.Random(seed)
    rows, truth = [], []
    names = ["".join(rng.choice("bdfgklmnprstvz") + rng.choice("aeiou") for _ in range(4)).title() for _ in range(brands)]
    for k, brand in enumerate(names):
        a = k % len(ARTICLES)
        for _ in range(size):
            product = (brand, a, rng.randrange(len(VARIANTS)), rng.choice([100, 150, 200, 250, 300, 400, 500, 750, 1000, 1500, 2000, 2500]))
            for _ in range(rng.choice([1, 2, 3, 4])):
                article, variant, grams = rng.choice(ARTICLES[a]), rng.choice(VARIANTS[product[2]]), product[3]
                content = rng.choice([f"{grams}g", f"{grams / 1000} kg".replace(".", ",")])
                name, rest = [article], [variant]
                (name if rng.random() < 0.7 else rest).append(brand)
                (name if rng.random() < 0.5 else rest).append(content)
                if rng.random() < 0.6:
                    name.append(rest.pop(0))
                rest.append(rng.choice(ADS))
                rng.shuffle(name)
                field, product_field = rng.choice(["", "", brand]), rng.choice(["", article])
                rows.append((rng.choice([" ", " - ", ", "]).join(name), field, product_field, "; ".join(rest), "", "1"))
                truth.append(product)
    return rows, truth


def run(spark, rows):
    df = spark.createDataFrame([(i, *r, "x", "y") for i, r in enumerate(rows)], SCHEMA)
    groups = product_groups(read_listings(df, "source_row_index", *FIELDS))
    pairs = [tuple(r) for r in same_product_pairs(groups).collect()]
    assert len(pairs) == len(set(pairs))
    return groups, set(pairs)


def test_reading():
    content, parts, marked, field, brand = read_listing("Xannaberg Surimisticks, in Dillsauce 0,5kg", "Xannaberg™", "Surimi-Stäbchen", "Aktion", "beutel", "1")
    assert (content, field, brand) == ("500", [["surimi", "stabchen"]], "xannaberg")
    assert parts == [["xannaberg", "surimisticks"], ["in", "dillsauce"], ["aktion"]] and marked == [*parts, *field]
    assert read_listing("Penne 3.000 g", "", "", "", "kg", "0,5")[0] == "500" and read_listing("Penne 3.000 g", "", "", "", "", "")[0] == "3000"
    assert read_listing("", "", "", "", "", "") == ("", [], [], [], "") and read_listing(None, None, None, None, None, None)[0] == "" and read_listing("500 g " * 5000, "", "", "", "kg", "x")[0] == "500"
    assert without(["von", "hof", "penne"], ["hof"]) == [["von"], ["penne"]] and without(["a"], []) == [["a"]]


def test_phrases_and_slips():
    known = Phrases({"gemusepfanne": 500, "gemusepfanen": 3, "ausholz": 90, "30fett": 60, "60fett": 1, "grob": 50})
    assert known.cut([["gemuse", "pfanne", "grob"]]) == (["gemusepfanne", "grob"], []) and known.own["gemusepfanen"] == "gemusepfanne"
    assert known.cut([["gemseupfanne", "und", "aus", "hlz"]]) == (["gemusepfanne", "ausholz"], ["und"])
    assert known.own["60fett"] == "60fett", "another number is no slip"
    rng = random.Random(2)
    for _ in range(300):
        w = "".join(rng.choice("abcdef") for _ in range(rng.randint(5, 12)))
        at = rng.randrange(len(w) - 1)
        slipped = rng.choice([w[:at] + w[at + 1 :], w[:at] + "x" + w[at:], w[:at] + "x" + w[at + 1 :], w[:at] + w[at + 1] + w[at] + w[at + 2 :]])
        if slipped != w and listings.slip(len(slipped)) >= 1:
            assert Phrases({w: 100}).meant(slipped, 0) == w
    assert edits("abc", "acb", 2) == 1 and edits("abc", "xyz", 1) == 2


def test_wordings():
    pairs = [("a", "b", 0.5), ("b", "c", 0.4), ("a", "c", -0.5), ("d", "e", 0.3), ("e", "f", 0.05)]
    assert wordings(pairs, 0.1) == {"a": "a", "b": "a", "c": "c", "d": "d", "e": "d"} and wordings([], 0.1) == {}


def test_learnt_wordings_find_the_products(spark, monkeypatch):
    monkeypatch.setattr(listings, "BLOCK", 97)
    rows, truth = corpus(4, 48, 14)
    read = read_listings(spark.createDataFrame([(i, *r, "x", "y") for i, r in enumerate(rows)], SCHEMA), "source_row_index", *FIELDS)
    told = understood(read, Scratch(spark, "told")).collect()
    assert len({r["article"] for r in told} - {""}) == len(ARTICLES)
    _, pairs = run(spark, rows)
    want = {(a, b) for a, b in itertools.combinations(range(len(rows)), 2) if truth[a] == truth[b]}
    assert len(pairs & want) >= 0.9 * len(want) and len(pairs & want) >= 0.95 * len(pairs)
    # Most of them have other words, so that only the alignment can have found them.
    words = {r["row"]: (r["named"], r["told"]) for r in told}
    assert sum(words[a] != words[b] for a, b in pairs) > len(pairs) / 2


def test_copies_in_a_hot_group(spark, monkeypatch):
    monkeypatch.setattr(listings, "HOT_GROUP", 16)
    rows = [("Hofxyz, Penne, grob", "Hofxyz", "Penne", "", "g", "500")] * 60 + [("Hofxyz, Penne, fein", "Hofxyz", "Penne", "", "g", "500")] * 30 + [(None, None, None, None, None, None)]
    groups, pairs = run(spark, rows)
    assert groups.count() == len(rows)
    assert pairs == {(a, b) for a, b in itertools.combinations(range(90), 2) if (a < 60) == (b < 60)}


def test_empty(spark):
    groups, pairs = run(spark, [])
    assert groups.count() == 0 and pairs == set()
