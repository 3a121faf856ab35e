"""Every registered query with SQL returns what DuckDB returns."""

import pytest

import __spark_entry__ as entry
from compare import connect, difference

WITH_SQL = sorted(entry.oracle_sql())


@pytest.fixture(scope="module")
def duck(folder):
    return connect(folder)


def test_every_sql_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() == 7


@pytest.mark.parametrize("name", WITH_SQL)
def test_query_equals_sql(spark, duck, folder, name):
    assert difference(entry.queries()[name](spark, folder), duck, entry.oracle_sql()[name]) is None
