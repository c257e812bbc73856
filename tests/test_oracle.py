"""Every query with an oracle agrees with it on the smallest tables."""

import pytest
from check import compare

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.mark.parametrize("name", list(SQL))
def test_matches_sql(spark, duck, name):
    assert compare(QUERIES[name](spark, SF), duck, SQL[name]).startswith("ok")


def test_oracles_belong_to_queries():
    assert set(SQL) <= set(QUERIES)


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["user_idx", "item_idx", "relevance", "rank"] and df.count() > 0
