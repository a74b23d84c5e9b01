"""Each registered query against its SQL over the test data."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_point
from tests.compare import duckdb_over, duckdb_result, spark_result
from verification.registry import QUERIES


@pytest.fixture(scope="module")
def duck(sf_dir):
    return duckdb_over(sf_dir)


def test_every_query_has_an_oracle():
    assert QUERIES.keys() <= entry_point.queries().keys()
    assert QUERIES.keys() <= entry_point.oracle_sql().keys() <= entry_point.queries().keys()


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, sf_dir, duck, name):
    types, rows = spark_result(entry_point.queries()[name](spark, sf_dir))
    expected_types, expected_rows = duckdb_result(duck, entry_point.oracle_sql()[name])
    assert types == expected_types
    assert rows == expected_rows


def test_entry(spark):
    result = entry_point.entry(spark)
    assert result.count() == 10
