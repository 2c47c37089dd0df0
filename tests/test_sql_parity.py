"""Every registered query against its SQL, all rows."""

import pytest
from oracle import compare, duck

import __spark_entry__ as e
from wardline.registry import catalog

QUERIES, SQL = catalog.queries(), catalog.oracle_sql()


@pytest.fixture(scope="module")
def con(sf):
    return duck(sf)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", list(QUERIES))
def test_rows_equal(spark, sf, con, name):
    assert compare(QUERIES[name](spark, sf), con, SQL[name]) == []


def test_entry(spark):
    assert e.entry(spark).count() > 0
