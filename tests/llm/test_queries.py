"""Queries with SQL give what DuckDB gives; the native ones plan no Python."""

from types import SimpleNamespace

import pytest

from check import compare, database
from tallyloom.llm.queries import ORACLE_SQL, QUERIES

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return database(SMALL)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, con, name):
    assert compare(spark, con, SimpleNamespace(build=QUERIES[name], sql=ORACLE_SQL[name]), SMALL).startswith("ok")


@pytest.mark.parametrize("number", [1, 4, 9])
def test_native(spark, number):
    name = next(n for n in QUERIES if n.startswith(f"op{number}_"))
    plan = QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not any(w in plan for w in ("Python", "Arrow", "Pandas", "Cartesian", "NestedLoop"))


def test_one_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
