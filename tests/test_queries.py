"""Every registered query against its SQL at the smallest scale."""

import pytest

import __spark_entry__ as entry
from tests.compare import connect, differences
from tierline.registry.oracle import oracle
from tierline.registry.queries import QUERIES

SF = "/root/testdata/sf0.001"
SQL = oracle()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_all_are_registered():
    assert QUERIES.items() <= entry.queries().items() and SQL.items() <= entry.oracle_sql().items()
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)
    assert set(QUERIES) - set(SQL) == {"warehouse_two_loads"}


@pytest.mark.parametrize("name", [n for n in QUERIES if n in SQL])
def test_query_matches_sql(spark, con, name):
    assert differences(spark, con, QUERIES[name], SQL[name], SF) == []


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "total_revenue" in df.columns
