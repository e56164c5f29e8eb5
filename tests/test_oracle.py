"""Every registered query equals its SQL on the given tables: values, names and types."""

import pytest
from oracle import connect, duckdb_rows, duckdb_types, spark_rows

import __spark_entry__ as entry

# The training-data operators have tests of their own.
QUERIES, ORACLES = entry.QUERIES, entry.ORACLES


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


@pytest.fixture(scope="module")
def sf_dir():
    from conftest import SF

    return SF


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    assert dict(df.dtypes) == duckdb_types(duck, ORACLES[name])
    got, expected = spark_rows(df), duckdb_rows(duck, ORACLES[name])
    assert got[0] == expected[0]
    assert got[1] == expected[1]


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["series_id", "series_label", "best_year", "total_value"]
    assert df.count() > 0
