"""Every query with SQL gives the rows that DuckDB gives."""

import pytest

import __spark_entry__ as entry_points
from tests.conftest import TESTDATA
from tagmatch.plans.queries import QUERIES as REFERENCE_QUERIES
from tests.oracle_check import connect, duckdb_rows, spark_rows

SF_DIR = f"{TESTDATA}/sf0.01"
QUERIES = entry_points.queries()
ORACLE = entry_points.oracle_sql()


@pytest.fixture(scope="module")
def connection():
    return connect(SF_DIR)


def test_every_query_of_the_reference_has_sql():
    assert set(REFERENCE_QUERIES) <= set(ORACLE)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, connection, name):
    got_columns, got = spark_rows(QUERIES[name](spark, SF_DIR))
    want_columns, want = duckdb_rows(connection, ORACLE[name])
    assert got_columns == want_columns
    assert len(got) == len(want) > 0
    assert got == want


def test_entry_has_rows(spark):
    result = entry_points.entry(spark)
    assert result.columns == ["app_id", "title", "similar_user_ids"]
    assert result.count() > 0
