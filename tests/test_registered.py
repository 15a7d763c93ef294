"""Every registered query equals its SQL on the small tables."""

import pytest
from compare import compare, duck

import __spark_entry__ as contract

from teledex.plans import registry

# The training-data queries have their own tests in tests/llm.
ORACLES = {name: sql for name, sql in contract.oracle_sql().items() if name in registry.QUERIES}
QUERIES = {name: query for name, query in contract.queries().items() if name in registry.QUERIES}


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, con, sf_dir, name):
    assert compare(spark, con, sf_dir, QUERIES[name], ORACLES[name]) is None


def test_entry_gives_ranked_rows(spark):
    rows = contract.entry(spark).collect()
    assert rows and {r.rank for r in rows} == set(range(1, 11))
