"""One key holding a third of all rows: results stay whole, and hot partitions are split."""

import duckdb
import pytest
from helpers import duck_multiset, spark_multiset
from pyspark.sql import functions as F

from fixtures.oracles import INPUTS, oracles
from fixtures.warehouse import CONTRACT_PARAMS, RENEWABLE_PARAMS, derive
from gridtally import (
    Warehouse,
    actual_volumes_renewable,
    contract_month_volumes,
    forecast_volumes_renewable,
)
from gridtally.session import SCALE

HOT = "xxhash64(product_key, meter_key, quote_mpan) % 3 = 0"

PLANS = {
    "contract_month_volumes": lambda w: contract_month_volumes(w, CONTRACT_PARAMS),
    "actual_volumes_renewable": lambda w: actual_volumes_renewable(w, RENEWABLE_PARAMS),
    "forecast_volumes_renewable": lambda w: forecast_volumes_renewable(w, RENEWABLE_PARAMS),
    "forecast_volumes_renewable_strict": lambda w: forecast_volumes_renewable(
        w, RENEWABLE_PARAMS, strict=True
    ),
}

SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.shuffle.partitions": "16",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "4k",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "32k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": SCALE[
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor"
    ],
    "spark.sql.files.maxPartitionBytes": "128k",
}


@pytest.fixture
def small_partitions(spark):
    before = {name: spark.conf.get(name, None) for name in SETTINGS}
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


@pytest.fixture(scope="module")
def skewed(spark, sf_medium, tmp_path_factory):
    """A third of the facts moved to one supply point, contract or meter each, and many copies."""
    root = str(tmp_path_factory.mktemp("skewed"))
    w = derive(spark, sf_medium)
    point = "0000000000001"
    hot_contract = w.contracts.where("quote_model = 'Fixed Renewable'").agg(
        F.max(F.struct("agreement_start_date", "contract_key"))["contract_key"]
    ).first()[0]
    copies = w.daily.where("quote_mpan = '0000000000601'").limit(1).withColumn(
        "copy", F.explode(F.sequence(F.lit(1), F.lit(20_000)))
    )
    tables = {
        "contracts": w.contracts,
        "customers": w.customers,
        "costs": w.costs,
        "daily": w.daily.withColumn(
            "quote_mpan", F.when(F.expr(HOT), point).otherwise(F.col("quote_mpan"))
        ).unionByName(copies.drop("copy")),
        "monthly": w.monthly.withColumn(
            "contract_key", F.when(F.expr(HOT), F.lit(hot_contract)).otherwise(F.col("contract_key"))
        ),
        "settlement": w.settlement,
    }
    for name, df in tables.items():
        df.repartition(8).write.parquet(f"{root}/{name}")
    return root


@pytest.mark.parametrize("name", PLANS)
def test_hot_keys(spark, skewed, small_partitions, name):
    tables = {table: spark.read.parquet(f"{skewed}/{table}") for table in INPUTS}
    result = PLANS[name](Warehouse(**tables))
    actual = spark_multiset(result)
    connection = duckdb.connect()
    for table in INPUTS:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{skewed}/{table}/*.parquet')"
        )
    assert actual == duck_multiset(connection, oracles(given=INPUTS)[name])
    assert actual
    result._jdf.queryExecution().toRdd().count()
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert "skew=true" in plan.split("== Initial Plan ==")[0]
