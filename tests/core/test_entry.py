import os

import pytest

import __spark_entry__ as entry

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def test_contract(spark):
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
@pytest.mark.parametrize("name", ["price_comparison", "p1_found", "p5_found", "tfidf_top_k", "offer_clusters", "cards_to_brochures", "log_levels"])
def test_runs(spark, name):
    df = entry.queries()[name](spark, FOLDER)
    assert df.count() >= 0 and len(set(df.columns)) == len(df.columns)
