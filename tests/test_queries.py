"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as contract
from checks import oracle, spark_queries
from checks.compare import connect, difference
from conftest import SMALLEST


def test_every_query_has_sql():
    assert set(spark_queries.queries()) == set(oracle.oracle_sql())
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(oracle.oracle_sql()))
def test_query_matches_sql(spark, name):
    assert difference(spark, connect(SMALLEST), SMALLEST, name) is None
