"""Every registered query against its DuckDB oracle on sf0.001."""

import pytest

import __spark_entry__ as entry
from compare import compare, duck
from conftest import SF0001

from kitwise.plans import extras
from kitwise.plans.catalog import all_queries

# the training-data queries have their own tests, in tests/llm
OWN = {**all_queries(), **extras.queries()}
QUERIES = {k: v for k, v in entry.queries().items() if k in OWN}
ORACLE = {k: v for k, v in entry.oracle_sql().items() if k in OWN}


@pytest.fixture(scope="module")
def con():
    return duck(SF0001)


def test_every_query_has_an_oracle():
    assert set(QUERIES) - set(ORACLE) == set()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    assert compare(QUERIES[name](spark, SF0001), con, ORACLE[name]) == []


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "weeks_of_stock" in df.columns
