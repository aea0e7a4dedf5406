import itertools
import random

import __spark_entry__ as entry


def test_every_offer_has_its_place(spark, tmp_path):
    rng = random.Random(7)
    rows = [(i, rng.choice(["METRO", "Edeka", "selgros", "selgros", "selgros"]), rng.choice([None, 1.0, round(rng.random() * 90, 1)])) for i in range(500)]
    rows += [(900 + i, "Handelshof", 5.0) for i in range(3)]
    spark.createDataFrame(rows, "ord bigint, supplier string, price double").write.parquet(f"{tmp_path}/offers.parquet")
    by = {}
    for o, s, p in sorted(rows, key=lambda r: (r[2] is None, -(r[2] or 0), r[0])):
        by.setdefault(s.lower(), []).append(o)
    mixed = [(s, o) for level in itertools.zip_longest(*[[(s, o) for o in by[s]] for s in sorted(by)]) for s, o in filter(None, level)]
    got = [tuple(r) for r in entry.queries()["interleave_suppliers"](spark, str(tmp_path)).collect()]
    assert got == [(i, *m) for i, m in enumerate(mixed, 1)]
