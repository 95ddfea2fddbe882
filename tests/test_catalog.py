"""Every catalog query at the smallest scale: equal to its SQL, or at least rows; estimates within their error."""

import pytest

import __spark_entry__ as entry
from oracle import compare, connect

SF = "/root/testdata/sf0.001"
SQL = entry.oracle_sql()
QUERIES = entry.queries()


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, duck, name):
    rows, problem = compare(spark, duck, SF, name, QUERIES[name], SQL.get(name))
    assert problem is None, problem
    assert rows >= 0


def test_every_sql_has_its_query():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
