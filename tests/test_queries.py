"""Every registered query with SQL gives what DuckDB gives on the smallest tables."""

import pytest

import __spark_entry__ as contract
from check import compare, database
from tallyloom.plans import load_all

SMALL = "/root/testdata/sf0.001"
CHECKED = sorted(n for n, q in load_all().items() if q.sql is not None)


@pytest.fixture(scope="module")
def con():
    return database(SMALL)


@pytest.mark.parametrize("name", CHECKED)
def test_query_matches_sql(spark, con, name):
    outcome = compare(spark, con, load_all()[name], SMALL)
    assert outcome.startswith("ok"), outcome


def test_contract(spark):
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert contract.entry(spark).count() > 0


def test_no_cartesian_product_of_tables():
    """No library module plans a cross join."""
    from pathlib import Path

    for path in Path(__file__).parent.parent.glob("tallyloom/**/*.py"):
        text = path.read_text()
        assert "crossJoin(" not in text and "localCheckpoint(" not in text, path
