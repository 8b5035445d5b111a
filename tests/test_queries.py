"""Every query with SQL returns what DuckDB returns; the others return rows of the expected kind."""

import pytest
from oracle import assert_same

import __spark_entry__
from rosterspark.queries import QUERIES, SQL


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    assert_same(spark, QUERIES[name], SQL[name])


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
