"""Every registered query equals its SQL counterpart at the smallest scale."""

import pytest

import __spark_entry__ as entry
from harness import oracles
from harness.check import compare, oracle_connection
from harness.queries import registry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return oracle_connection(SF)


def test_every_query_has_a_counterpart():
    assert set(registry()) == set(oracles.sql())
    assert set(registry()) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns[0] == "revenue_date" and df.count() > 0


@pytest.mark.parametrize("name", sorted(registry()))
def test_query(spark, connection, name):
    assert compare(spark, connection, name, SF) == ""
