"""Loading from Parquet and from the catalog, and the checks made on the way."""

import pytest
from helpers import frame, spark_multiset
from pyspark.sql import types as T

from fixtures.warehouse import CONTRACT_PARAMS, RENEWABLE_PARAMS, derive
from gridtally import (
    Warehouse,
    actual_volumes_renewable,
    contract_month_volumes,
    forecast_volumes_renewable,
)
from gridtally.sources import schemas
from gridtally.sources.warehouse import TABLES, conform, duplicate_keys

PLANS = [
    lambda w: contract_month_volumes(w, CONTRACT_PARAMS),
    lambda w: actual_volumes_renewable(w, RENEWABLE_PARAMS),
    lambda w: forecast_volumes_renewable(w, RENEWABLE_PARAMS),
]


@pytest.fixture(scope="module")
def written(spark, sf_small, tmp_path_factory):
    """The derived tables with text keys, as Parquet folders."""
    root = str(tmp_path_factory.mktemp("warehouse"))
    derived = derive(spark, sf_small)
    for attribute, (name, schema) in TABLES.items():
        df = conform(getattr(derived, attribute), schema, name)
        if {"year", "month"} <= set(df.columns):
            df.repartition("year", "month").write.partitionBy("year", "month").parquet(f"{root}/{name}")
        else:
            df.write.parquet(f"{root}/{name}")
    return root


def test_loaded_tables_have_the_declared_schema(spark, written):
    loaded = Warehouse.from_parquet(spark, written)
    for attribute, (_, schema) in TABLES.items():
        found = getattr(loaded, attribute).schema
        assert [(f.name, f.dataType) for f in found] == [(f.name, f.dataType) for f in schema]


def test_plans_run_on_loaded_tables(spark, written, sf_small):
    derived = derive(spark, sf_small)
    in_memory = Warehouse(
        **{
            attribute: conform(getattr(derived, attribute), schema, name)
            for attribute, (name, schema) in TABLES.items()
        }
    )
    loaded = Warehouse.from_parquet(spark, written)
    for plan in PLANS:
        assert spark_multiset(plan(loaded)) == spark_multiset(plan(in_memory))


def test_catalog_tables(spark, written):
    loaded = Warehouse.from_parquet(spark, written)
    for attribute, (name, _) in TABLES.items():
        getattr(loaded, attribute).createOrReplaceTempView(name)
    renamed = {"dim_customer": "clients"}
    loaded.customers.createOrReplaceTempView("clients")
    named = Warehouse.from_catalog(spark, names=renamed)
    assert spark_multiset(PLANS[1](named)) == spark_multiset(PLANS[1](loaded))


def test_path_of_one_table_can_differ(spark, written):
    paths = {"dim_customer": f"{written}/dim_customer"}
    assert Warehouse.from_parquet(spark, written, paths).customers.count() > 0


def test_missing_columns_are_named(spark):
    df = spark.createDataFrame([("u1",)], "customer_key string")
    with pytest.raises(ValueError, match="dim_customer lacks columns companyno"):
        conform(df, schemas.DIM_CUSTOMER, "dim_customer")


def test_column_names_ignore_case(spark):
    df = spark.createDataFrame([("u1", "1")], "CUSTOMER_KEY string, CompanyNo string")
    assert conform(df, schemas.DIM_CUSTOMER, "dim_customer").columns == ["customer_key", "companyno"]


def test_float_volumes_become_exact(spark):
    row = {f.name: None for f in schemas.FACT_SETTLEMENT_MONTHLY.fields}
    schema = T.StructType(
        [
            T.StructField(f.name, T.DoubleType() if "volume" in f.name else f.dataType)
            for f in schemas.FACT_SETTLEMENT_MONTHLY.fields
        ]
    )
    df = frame(spark, schema, [{**row, "settlement_site_volume_kwh": 0.1}])
    loaded = conform(df, schemas.FACT_SETTLEMENT_MONTHLY, "settlement")
    assert str(loaded.first()["settlement_site_volume_kwh"]) == "0.100"


def test_value_that_does_not_fit_raises(spark):
    df = spark.createDataFrame([("m1", "k", "twenty", "20230101")], schemas.FACT_COST_MONTHLY.names)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        conform(df, schemas.FACT_COST_MONTHLY, "costs").collect()


def test_duplicate_keys(spark):
    df = spark.createDataFrame([("u1",), ("u2",), ("u1",)], "customer_key string")
    assert [tuple(r) for r in duplicate_keys(df, "customer_key").collect()] == [("u1", 2)]
