"""Every registered query against its DuckDB statement."""

import os

import pytest

import __spark_entry__ as entry
from heronlake.catalog import QUERIES
from tests.oracle import compare, connect

FOLDER = os.environ.get("SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, duck):
    df = entry.queries()[name](spark, FOLDER)
    assert compare(df, duck, entry.oracle_sql()[name]) is None


def test_every_query_has_an_oracle():
    """Training-data queries without a statement are held against brute force in tests/llm."""
    assert {name for name, q in QUERIES.items() if not q.sql} == set()
    assert set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


def test_comparison_sees_differences(spark, duck):
    df = spark.sql("select 1L as a, 2.5D as b")
    assert compare(df, duck, "select 1::bigint as a, 2.5::double as b") is None
    assert compare(df, duck, "select 1::bigint as a, 2.6::double as b")
    assert compare(df, duck, "select 1::int as a, 2.5::double as b")
    assert compare(df, duck, "select 1::bigint as a, 2.5::double as c")


def test_entry(spark):
    assert entry.entry(spark).columns == ["month", "revenue", "prev_month", "mom_growth_pct"]
