"""The registered queries of this subpackage on the smallest tables."""

import pytest

import __spark_entry__ as contract
from checks.compare import connect, lines
from haemoloom.llm import oracle, queries

SMALLEST = "/root/testdata/sf0.001"


def test_all_queries_are_registered():
    assert set(queries.queries()) | {"pipeline"} <= set(contract.queries())
    assert set(oracle.oracle_sql()) <= set(contract.oracle_sql())
    assert {int(name[2:].split("_")[0]) for name in queries.queries()} == set(range(1, 14))


@pytest.mark.parametrize("name", sorted(oracle.oracle_sql()))
def test_query_matches_sql(spark, name):
    left = contract.queries()[name](spark, SMALLEST).toPandas()
    right = connect(SMALLEST).sql(oracle.oracle_sql()[name]).df()
    assert sorted(left.columns) == sorted(right.columns)
    assert lines(left) == lines(right)


@pytest.mark.parametrize("name", sorted(set(queries.queries()) - set(oracle.oracle_sql())))
def test_query_has_a_row_for_each_document(spark, name):
    got = contract.queries()[name](spark, SMALLEST)
    documents = spark.read.parquet(f"{SMALLEST}/documents.parquet").select("doc_id")
    assert got.select("doc_id").distinct().count() == documents.count()
