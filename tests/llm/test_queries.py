"""Queries with SQL against DuckDB; the others are held against brute force in the operators' tests."""

import pytest

from coursepulse.llm.queries import ORACLE_SQL, QUERIES
from tests.oracle import compare, duck

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, con, name):
    r = compare(spark, name, QUERIES[name], ORACLE_SQL[name], SF, con)
    assert r["status"] == "ok", r
