import random

import pytest

import offerloom.llm.components as components
from offerloom.llm.components import linked_groups

SCHEMA = "a string, b string, id string, group_id int"


def brute(pairs):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in pairs:
        if a is not None and b is not None and a != b:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return sorted((v, find(v)) for v in root)


@pytest.mark.parametrize("hot", [100_000, 20])
def test_shapes(spark, monkeypatch, hot):
    monkeypatch.setattr(components, "HOT_DEGREE", hot)
    rng = random.Random(2)
    pairs = [(f"r{rng.randint(0, 90)}", f"r{rng.randint(0, 90)}") for _ in range(60)]
    pairs += [(f"c{i:03}", f"c{i + 1:03}") for i in range(70)] + [("hub", f"s{i}") for i in range(80)]
    pairs += pairs[:30] + [(b, a) for a, b in pairs[:30]] + [(None, "x"), ("x", None), ("y", "y"), (None, None)]
    df = spark.createDataFrame([(a, b, "z", 0) for a, b in pairs], SCHEMA)
    assert sorted(tuple(r) for r in linked_groups(df, "a", "b").collect()) == brute(pairs)


def test_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    out = linked_groups(df, "a", "b")
    assert out.columns == ["id", "group_id"] and out.count() == 0
