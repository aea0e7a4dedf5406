import random
import re
import unicodedata

from pyspark.sql import functions as F

import offerloom.llm.leaks as leaks_module
from offerloom.llm.leaks import BUDGET, PIECE, REACH, WORDS, folded_words, leaks, myers, passages, reach

ITEMS = {i: " ".join(f"{random.Random(i * 100 + k).choice(['Käse', 'für', 'neun', 'Öl', 'Straße', 'Hahn', 'gut'])}{k * 7 + i}" for k in range(40 + i)) for i in range(6)}


def run(spark, docs, items=None):
    d = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(docs)], "doc_id bigint, text string, doc string, item int")
    b = spark.createDataFrame(list((ITEMS if items is None else items).items()), "item_id bigint, text string")
    return {tuple(r) for r in leaks(d, "doc_id", "text", b, "item_id", "text").collect()}


def cut(i, a, n):
    return " ".join(ITEMS[i].split()[a : a + n])


def test_forms(spark, monkeypatch):
    p = cut(1, 3, 15)
    docs = [
        f"Vorher {p} nachher", f"x {cut(1, 3, 14)} y", p.upper(), p.replace(" ", "\xa0–\t"), p.replace("ä", "ae").replace("ö", "oe").replace("ü", "ue").replace("ß", "ss"), p.encode().decode("latin-1"),
        unicodedata.normalize("NFD", p), re.sub(r"(\w{3})(\w)", "\\1-\n\\2", p, count=1), p[:20] + "\u200b" + p[20:], None, "", "  ", "wort " * 50_000 + cut(2, 10, 20) + " ende" * 50_000,
        f"{cut(3, 0, 10)} fremd {cut(3, 10, 10)}", f"{cut(4, 5, 16)} und {cut(5, 20, 16)}", ITEMS[0], "ab" + p, p + "ab",
    ]
    want = {(0, 1), (2, 1), (3, 1), (4, 1), (5, 1), (6, 1), (7, 1), (8, 1), (12, 2), (14, 4), (14, 5), (15, 0)}
    assert run(spark, docs) == want
    monkeypatch.setattr(leaks_module, "BLOCK_CHARS", 400)
    assert run(spark, docs) == want


def test_random_against_windows(spark):
    rng = random.Random(9)
    docs = []
    for _ in range(60):
        i, n = rng.randint(0, 5), rng.randint(12, 18)
        words = cut(i, rng.randint(0, 20), n).split()
        if rng.random() < 0.4:
            words[rng.randint(0, n - 1)] = "anders"
        docs.append("a " * rng.randint(0, 3) + " ".join(words) + " z" * rng.randint(0, 3))
    windows = {}
    for i, t in ITEMS.items():
        w = t.split()
        for k in range(len(w) - 14):
            windows.setdefault(tuple(w[k : k + 15]), set()).add(i)
    want = {(d, i) for d, t in enumerate(docs) for w in [t.split()] for k in range(len(w) - 14) for i in windows.get(tuple(w[k : k + 15]), ())}
    assert run(spark, docs) == want


def test_empty(spark):
    assert run(spark, []) == set() and run(spark, ["x"], {}) == set()
    assert run(spark, [ITEMS[0]] * 2, {7: "zu kurz", 8: None}) == set()


def test_pieces(spark):
    def best(p, t):
        row = [0] * (len(t) + 1)
        for i, x in enumerate(p, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(t, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        return min(row)

    rng = random.Random(3)
    for _ in range(200):
        p, t = ("".join(rng.choice("abc") for _ in range(rng.randint(0, 12))) for _ in range(2))
        assert myers(p, t) == best(p, t)
    assert BUDGET == 1
    assert spark.range(1).select(folded_words(F.lit("Neue Größe: „Süß-\n speise“ 3,5"))).first()[0] == "neu grosse sussspeise 3 5"


def edited(spark, docs):
    d = spark.createDataFrame(list(enumerate(docs)), "doc_id bigint, text string")
    b = spark.createDataFrame(list(ITEMS.items()), "item_id bigint, text string")
    return {(r["doc_id"], r["item_id"]): r["edits"] for r in passages(d, "doc_id", "text", b, "item_id", "text").collect()}


def test_edited_passages_are_decided_by_the_distance(spark, monkeypatch):
    rng = random.Random(5)
    docs, chars = [], {i: t for i, t in ITEMS.items()}
    for k in range(80):
        words = cut(k % 6, rng.randint(0, 20), 15).split()
        for _ in range(rng.choice([0, 1, 1, 2])):
            at = rng.randrange(15)
            w = words[at]
            words[at] = rng.choice([w + "x", w[1:], "x" + w[1:], w[:-1] + "x"])
        docs.append("vor " + " ".join(words) + " nach")
    plain = lambda t: "".join(r[0].split()) if (r := fold[t]) else ""
    every = [*docs, *(" ".join(t.split()[k : k + 15]) for t in chars.values() for k in range(len(t.split()) - 14))]
    folded = spark.createDataFrame([(t,) for t in every], "t string").select("t", folded_words(F.col("t")).alias("w")).collect()
    fold = {r["t"]: (r["w"],) for r in folded}
    want = {}
    for d, text in enumerate(docs):
        for i, t in chars.items():
            w = t.split()
            best = min(myers(plain(" ".join(w[k : k + 15])), plain(text)) for k in range(len(w) - 14))
            if best <= BUDGET:
                want[d, i] = best
    got = edited(spark, docs)
    assert set(got) == set(want) and {0, 1} <= set(want.values())
    assert all(got[k] == v for k, v in want.items() if v) and all(got[k] in (0, 1) for k in want)
    monkeypatch.setattr(leaks_module, "myers", lambda *_: 0)
    finder = leaks_module.Finder([(i, fold_item) for i, fold_item in ((i, " ".join(ITEMS[i].lower().split())) for i in (0,))])
    words = ITEMS[0].lower().split()[:15]
    words[7] = "ganz"
    words[12] = "anders"
    assert finder.distances(" ".join(words)), "with the distance switched off a passage with two foreign words passes"


def test_reach():
    assert (WORDS, PIECE, BUDGET, REACH) == (15, 5, 1, 6) and reach(15, 4, 2) >= 4 and reach(15, 8, 0) == 15
