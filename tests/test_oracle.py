"""Every registered query against its DuckDB recomputation (sf0.001)."""

import os

import pytest

import __spark_entry__ as E
from oracle import compare, duck

SF = os.environ.get("SIFTLANE_TEST_SF", "/root/testdata/sf0.001")
QUERIES = {k: v for k, v in E.queries().items() if k[0] == "q"}
SQL = {k: v for k, v in E.oracle_sql().items() if k in QUERIES}


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(QUERIES[name](spark, SF), con, SQL[name])
    assert ok, msg


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["query_id", "rank", "id", "score", "ham", "stage1_rank"]
