"""Facts stored by their join keys: the same rows, and no exchange of the fact."""

import re

import pytest
from helpers import spark_multiset
from pyspark.sql import functions as F
from test_plans import planned

from fixtures.warehouse import CONTRACT_PARAMS, RENEWABLE_PARAMS, derive
from gridtally import Warehouse, actual_volumes_renewable, configure, contract_month_volumes
from gridtally.operators import selection, small_sides
from gridtally.sources import layout
from gridtally.sources.warehouse import TABLES, conform


@pytest.fixture(scope="module")
def plain(spark, sf_small, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("plain"))
    derived = derive(spark, sf_small)
    for attribute, (name, schema) in TABLES.items():
        rows = conform(getattr(derived, attribute), schema, name)
        if attribute == "daily":  # rows without a day, and copies of them
            odd = rows.where("product_key = '3'").withColumn("delivery_date_key", F.lit(None).cast("string"))
            rows = rows.unionByName(odd).unionByName(odd)
        rows.write.parquet(f"{root}/{name}")
    return Warehouse.from_parquet(spark, root)


@pytest.fixture(scope="module")
def stored(spark, plain):
    spark.sql("CREATE DATABASE laid_out")
    layout.write_laid_out(plain, "laid_out", buckets=4)
    yield Warehouse.from_catalog(spark, "laid_out")
    spark.sql("DROP DATABASE laid_out CASCADE")


@pytest.fixture
def relying(spark):
    configure(spark, laid_out=True)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    yield
    configure(spark)
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def between(plan, table, column):
    """The operators from the scan of ``column`` of ``table`` up to the root, nearest first."""
    lines = plan.splitlines()
    at = next(i for i, x in enumerate(lines) if "FileScan" in x and table in x and f"{column}#" in x)
    depth = lambda x: len(re.match(r"[ :+\-]*", x).group())
    above, least = [], depth(lines[at])
    for line in reversed(lines[:at]):
        if depth(line) < least:
            least = depth(line)
            above.append(line.strip(" :+-"))
    return above


def test_contract_plan_does_not_exchange_the_daily_fact(spark, plain, stored, relying):
    def plan(w):
        points = small_sides.prepare_side(selection.select_mpans(w.costs, CONTRACT_PARAMS))
        return contract_month_volumes(w, CONTRACT_PARAMS, points, laid_out=w is stored)

    result = plan(stored)
    above = between(planned(result), "fact_elec_consumption_current_daily", "nbp_volume_kwh")
    first = next(i for i, x in enumerate(above) if x.startswith("Exchange"))
    assert any("Join" in x and "_day#" in x for x in above[:first]), above
    assert "calendarmonthkey" in above[first]  # the partial monthly sums
    flags = between(planned(result), "fact_elec_consumption_current_daily", "itron_forecast_key_lt")
    assert [x for x in flags if x.startswith(("Exchange", "HashAggregate"))][1].startswith("HashAggregate")
    rows = spark_multiset(result)
    configure(spark)
    assert rows == spark_multiset(plan(plain)) and rows


def test_settled_plan_does_not_exchange_the_settlement_fact(spark, plain, stored, relying):
    result = actual_volumes_renewable(stored, RENEWABLE_PARAMS)
    above = between(planned(result), "settlement_consumption", "settlement_site_volume_kwh")
    first = next(i for i, x in enumerate(above) if x.startswith("Exchange"))
    met = [i for i, x in enumerate(above) if "Join" in x and "Inner" in x and "meter_key#" in x]
    assert met and met[0] < first, above
    rows = spark_multiset(result)
    configure(spark)
    assert rows == spark_multiset(actual_volumes_renewable(plain, RENEWABLE_PARAMS)) and rows


def test_largest_share(spark):
    rows = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "meter_key string")
    assert layout.largest_share(rows, "settlement") == 0.5
    assert layout.largest_share(rows.limit(0), "settlement") == 0


def test_buckets_follow_the_size_of_the_facts(spark, plain, monkeypatch):
    spark.sql("CREATE DATABASE sized")
    monkeypatch.setattr(layout, "TARGET_PARTITION_BYTES", 1 << 17)
    layout.write_laid_out(plain, "sized")
    described = spark.sql("DESCRIBE EXTENDED sized.fact_elec_consumption_current_daily").collect()
    found = int(next(r.data_type for r in described if r.col_name == "Num Buckets"))
    assert found > 1
    spark.sql("DROP DATABASE sized CASCADE")
