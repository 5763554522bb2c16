"""Each registered query that SQL can express gives what the SQL gives."""

import pytest

import __spark_entry__ as entry_point
from tests.oracle_check import connect, differences

QUERIES = entry_point.queries()
SQL = entry_point.oracle_sql()


@pytest.fixture(scope="module")
def connection(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, sf_dir, connection, name):
    assert differences(QUERIES[name](spark, sf_dir), connection, SQL[name]) == []


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry_runs(spark):
    assert entry_point.entry(spark).count() > 0
