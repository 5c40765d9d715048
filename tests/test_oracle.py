import pytest

from __spark_entry__ import entry, oracle_sql, queries

from .oracle import compare, connect


@pytest.fixture(scope="module")
def con():
    return connect()


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_its_sql(spark, con, name):
    compare(spark, con, queries()[name], oracle_sql()[name])


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    rows = entry(spark).collect()
    assert rows and 0 <= rows[0]["held_out_auc"] <= 1
