"""Every registered query against its DuckDB oracle on the smallest driver tables."""

import pytest

import __spark_entry__ as E
from harness import compare_one, duck

SF = "/root/testdata/sf0.001"
QUERIES = E.queries()
ORACLE = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    r = compare_one(spark, con, name, QUERIES[name], ORACLE.get(name), SF)
    assert r["status"] in ("ok", "rows-only"), r


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and df.columns[:2] == ["source", "lang"]
