import pytest

import offerloom.llm.canonical as canonical
from offerloom.llm.canonical import map_to_list, pigeonhole_join
from offerloom.llm.listings import edits

CANON = [("Lachsfilet mit Haut", "salmfilet mit haut"), ("Lachsfilet ohne Haut", None), ("Spargel grün", "grünspargel"), ("Kartoffeln festkochend", "salatkartoffeln"), ("Mango", "flugmango"), ("Matjesfilet", "jungheringsfilet"), ("Bananen", "bananen,bananen"), ("Feta", "")]
NAMES = {
    "Lachsfilet o. Haut, 2 x 500 g": "Lachsfilet ohne Haut", "SPARGEL GRUEN": "Spargel grün", "grün Spargel": "Spargel grün", "Grünspragel": "Spargel grün", "Salat- kartoffeln": "Kartoffeln festkochend",
    "Kartoffel Salat": "", "filet / Matjes-": "Matjesfilet", "Jungherings filet Bio": "Matjesfilet", "Bananen chips": "", "Mangochutney": "", "Bio  Feta": "Feta", "Tofu": "", "": "", "!!": "", "Magno Bio": "Mango", "x" * 50_000: "",
}


def frame(spark, names):
    rows = [(i, n, 0, "k") for i, n in enumerate(names)]
    return spark.createDataFrame(rows, "ord bigint, name string, n int, text string")


def listed(spark, rows=CANON):
    return spark.createDataFrame(rows, "canonical string, keywords string")


@pytest.mark.parametrize("hot", [200_000, 2])
def test_names(spark, monkeypatch, hot):
    monkeypatch.setattr(canonical, "HOT_ROWS", hot)
    spread = [f"{w} {c[0]}" for c in CANON for w in ("Bio", "g")]
    names = [*NAMES, None, *spread]
    got = {r["ord"]: r["canonical_name"] for r in map_to_list(frame(spark, names), "ord", "name", listed(spark), "canonical", "keywords").collect()}
    assert [got[i] for i in range(len(NAMES))] == list(NAMES.values())
    assert got[len(NAMES)] == "" and len(got) == len(names)


def test_empty_sides(spark):
    assert map_to_list(frame(spark, []), "ord", "name", listed(spark), "canonical", "keywords").count() == 0
    assert [r["canonical_name"] for r in map_to_list(frame(spark, ["Feta", "Feta"]), "ord", "name", listed(spark, []), "canonical", "keywords").collect()] == ["", ""]


def test_pigeonhole_loses_nothing(spark):
    import random

    rng = random.Random(5)
    forms = ["".join(rng.choice("abcd") for _ in range(rng.randint(3, 14))) for _ in range(60)]
    forms = sorted(set(forms))
    cores = set()
    for f in forms:
        for _ in range(4):
            s = list(f)
            for _ in range(rng.randint(0, 3)):
                i = rng.randint(0, len(s) - 1) if s else 0
                op = rng.randint(0, 2)
                s[i : i + (op > 0)] = [rng.choice("abcd")] if op < 2 else []
            cores.add("".join(s))
    df = spark.createDataFrame([(c,) for c in sorted(cores)], "core string")
    fm = spark.createDataFrame([(f, f, False) for f in forms], "form string, canonical string, phrase boolean")
    got = {r["core"]: (r["canonical"], r["edits"]) for r in pigeonhole_join(df, fm).collect()}

    def lev(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        return row[-1]

    def most(c, f):
        n = len(f)
        return 2 if n >= 7 else (2 if n >= 5 and sorted(c) == sorted(f) else 1) if n >= 5 else 0

    for c in cores:
        near = [(lev(c, f), -len(f), f) for f in forms if lev(c, f) <= most(c, f)]
        assert (got.get(c) is None) == (not near), c
        if near:
            assert got[c] == (min(near)[2], min(near)[0]), c
    assert edits("abdc", "abcd", 2) == 1
