"""Every registered query against its DuckDB twin, on whole tables."""

import duckdb
import pytest
from helpers import duck_multiset, spark_multiset

import __spark_entry__ as entry_module
from fixtures.oracles import oracles

QUERIES = entry_module.core_queries()
ORACLES = oracles()


@pytest.fixture(scope="module")
def duck(sf_medium):
    connection = duckdb.connect()
    for table in ("orders", "lineitem", "customer"):
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_medium}/{table}.parquet')"
        )
    return connection


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert QUERIES.keys() <= entry_module.queries().keys()
    assert ORACLES.items() <= entry_module.oracle_sql().items()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_oracle(spark, duck, sf_medium, name):
    result = QUERIES[name](spark, sf_medium)
    described = [column[0] for column in duck.execute(ORACLES[name]).description]
    assert sorted(result.columns) == sorted(described)
    assert spark_multiset(result) == duck_multiset(duck, ORACLES[name])


def test_row_counts_of_the_plans(spark, sf_medium):
    expected = {
        "contract_month_volumes": 33_970,
        "actual_volumes_renewable": 769,
        "forecast_volumes_renewable": 383,
        "forecast_volumes_renewable_strict": 277,
    }
    assert {name: QUERIES[name](spark, sf_medium).count() for name in expected} == expected


def test_entry_has_rows(spark):
    assert entry_module.entry(spark).limit(1).count() == 1
