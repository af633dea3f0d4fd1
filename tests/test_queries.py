"""Every query against its SQL on the smallest tables."""

from __future__ import annotations

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from suite.compare import database, difference, spark_rows, sql_rows
from suite.queries import QUERIES

SMALLEST = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    connection = database(SMALLEST)
    yield connection
    connection.close()


def test_every_query_has_sql():
    assert set(QUERIES) <= set(oracle_sql()) <= set(queries())


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["date", "topic", "word", "count"] and df.count() > 0


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query(spark, connection, name):
    found = spark_rows(queries()[name](spark, SMALLEST))
    assert difference(found, sql_rows(connection, oracle_sql()[name])) is None
