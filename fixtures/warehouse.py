"""Derives the six input tables from ``orders``, ``lineitem`` and ``customer`` (see FIXTURES.md).

Integer keys stay integers here: the operators take keys of any type that has an order.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridtally import ContractVolumeParams, FiscalWindow, RenewableParams, Warehouse
from gridtally.functions.volumes import KWH

CONTRACT_PARAMS = ContractVolumeParams(
    cost_component="59b1",
    year_from=2000,
    won_from=date(1998, 9, 13),
    won_to=date(1999, 9, 21),
    excluded_mpans=("0000000000021", "0000000000022"),
)
WINDOW = FiscalWindow(datetime(1998, 4, 1), datetime(1999, 3, 31, 23, 59, 59))
OVERRIDES = tuple(f"Q{customer:08d}" for customer in range(0, 1500, 20))
RENEWABLE_PARAMS = RenewableParams(window=WINDOW, overrides=OVERRIDES)

# The columns used, declared so that no job has to read a footer first.
_TEST_TABLES = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "customer": "c_custkey bigint",
}


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(_TEST_TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def _quote(customer: Column) -> Column:
    return F.concat(F.lit("Q"), F.lpad(customer.cast("string"), 8, "0"))


def _ymd(year: Column, month: Column, day: Column) -> Column:
    return (year * 10000 + month * 100 + day).cast("string")


def _lines(spark: SparkSession, sf_dir: str, shared: bool = False) -> DataFrame:
    """One row per line item with the keys and volumes that several tables share.

    The test file is one row group, hence one scan task. Partitioning it by the join key spreads the
    rest over all cores, and is the exchange a sort-merge join with orders would need anyway. ``shared`` lines
    keep all their columns up to the join, whatever is read of them, so that tables which a plan reads together
    exchange line items and orders once. What is used of part and date is taken before the exchange, being shorter.
    """
    line = _read(spark, sf_dir, "lineitem").select(
        "*",
        (F.col("l_partkey") % 3).alias("part_third"),
        F.year("l_shipdate").alias("ship_year"),
        F.month("l_shipdate").alias("ship_month"),
    )
    line = line.drop("l_partkey", "l_shipdate").repartition("l_orderkey")
    order = _read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    customer = F.col("o_custkey")
    meter = (customer - customer % 2) * 10 + F.col("part_third")
    joined = line.join(order, F.col("l_orderkey") == F.col("o_orderkey"))
    if shared:
        # Neither the choice of columns nor a filter passes a generator.
        joined = joined.select(F.inline(F.array(F.struct("*"))))
    return joined.select(
        "*",
        meter.alias("meter"),
        F.lpad(meter.cast("string"), 13, "0").alias("point"),
        _quote(customer).alias("quote"),
        F.col("l_quantity").cast(KWH).alias("q"),
        F.col("l_extendedprice").cast(KWH).alias("p"),
        _ymd(F.year("o_orderdate"), F.month("o_orderdate"), F.day("o_orderdate")).alias("won_key"),
    )


def _kwh(volume: Column, name: str) -> Column:
    return volume.cast(KWH).alias(name)


def _contracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = _read(spark, sf_dir, "orders")
    key, start = F.col("o_orderkey"), F.col("o_orderdate")
    cancelled = F.col("o_orderstatus") == "P"
    priority = F.col("o_orderpriority")
    return order.where(key % 13 != 0).select(
        key.alias("contract_key"),
        _quote(F.col("o_custkey")).alias("contract_reference"),
        F.when(key % 11 != 0, key % 5).cast("int").alias("agreement_number"),
        start.alias("agreement_start_date"),
        (start + F.expr("INTERVAL 730 DAYS")).alias("agreement_end_date"),
        F.when(cancelled, "Y").otherwise("N").alias("agreement_cancelled_flag"),
        F.when(cancelled, start + F.expr("INTERVAL 180 DAYS")).alias("agreement_cancellation_date"),
        F.when(priority == "1-URGENT", "Fixed Renewable")
        .when(priority == "2-HIGH", "Fixed No Renewable")
        .when(priority == "3-MEDIUM", None)
        .otherwise("Fixed Standard")
        .alias("quote_model"),
    )


def _costs(lines: DataFrame) -> DataFrame:
    return lines.select(
        F.col("point").alias("quote_mpan"),
        F.when(F.col("meter") % 10 == 0, "other").otherwise("59b1").alias("costcomponent_key"),
        F.col("ship_year").alias("year"),
        F.col("won_key").alias("contract_won_date_key"),
    )


def _daily(lines: DataFrame) -> DataFrame:
    number, q, p = F.col("l_linenumber"), F.col("q"), F.col("p")
    copies = F.when(F.col("meter") % 10 == 1, F.array(F.lit(1), F.lit(2))).otherwise(
        F.array(F.lit(1))
    )
    rows = lines.select(
        F.when(number != 7, F.col("l_orderkey")).alias("contract_key"),
        F.col("quote").alias("contract_reference"),
        F.col("meter").alias("meter_key"),
        F.col("o_custkey").alias("customer_key"),
        F.col("l_suppkey").alias("product_key"),
        F.col("point").alias("quote_mpan"),
        _ymd(F.col("ship_year"), F.col("ship_month"), F.lit(1)).alias("delivery_date_key"),
        F.col("won_key").alias("contract_won_date_key"),
        F.concat(F.lit("P"), F.col("ship_month").cast("string")).alias("fin_rep_period"),
        F.lit("2002-01-01").alias("snapshot_date"),
        F.when(F.col("l_returnflag") != "N", number).alias("itron_forecast_key_lt"),
        F.when(number != 3, q).alias("nbp_volume_kwh"),
        _kwh(q * 2, "gsp_volume_kwh"),
        _kwh(p, "site_volume_kwh"),
        _kwh(q * 3, "reforecasted_nbp_volume_lt"),
        _kwh(q * 4, "reforecasted_gsp_volume_lt"),
        F.when(number != 2, (p * 2).cast(KWH)).alias("reforecasted_msp_volume_lt"),
        F.explode(copies).alias("copy"),
    )
    return rows.drop("copy")


def _monthly(lines: DataFrame) -> DataFrame:
    q, p = F.col("q"), F.col("p")
    return lines.select(
        F.col("l_orderkey").alias("contract_key"),
        F.col("quote").alias("contract_reference"),
        F.col("o_custkey").alias("customer_key"),
        F.col("l_suppkey").alias("product_key"),
        F.col("meter").alias("meter_key"),
        F.col("point").alias("quote_mpan"),
        F.col("point").alias("mpan"),
        F.col("ship_year").alias("year"),
        F.col("ship_month").alias("month"),
        _kwh(p, "site_volume_kwh"),
        _kwh(q * 2, "gsp_volume_kwh"),
        _kwh(q, "nbp_volume_kwh"),
        _kwh(p * 2, "reforecasted_msp_volume_st"),
        _kwh(q * 3, "reforecasted_gsp_volume_st"),
        _kwh(q * 5, "reforecasted_nbp_volume_st"),
        _kwh(p * 3, "reforecasted_msp_volume_lt"),
        _kwh(q * 7, "reforecasted_gsp_volume_lt"),
        _kwh(q * 9, "reforecasted_nbp_volume_lt"),
    )


def _settlement(lines: DataFrame) -> DataFrame:
    q, p = F.col("q"), F.col("p")
    flag = F.col("l_returnflag")
    return lines.select(
        F.col("meter").alias("meter_key"),
        F.col("point").alias("mpan"),
        F.when(F.col("l_linestatus") == "O", "NHH").otherwise("HH").alias("meter_type"),
        F.when(flag == "A", "AI").when(flag == "R", "RI").alias("measurement_quantity_id"),
        F.when(F.col("l_linenumber") % 3 == 0, "E")
        .otherwise("A")
        .alias("actual_estimate_indicator"),
        F.col("ship_year").alias("year"),
        F.col("ship_month").alias("month"),
        _kwh(p, "settlement_site_volume_kwh"),
        _kwh(q * 2, "settlement_gsp_volume_kwh"),
        _kwh(q, "settlement_nbp_volume_kwh"),
    )


def _customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    text = key.cast("string")
    return _read(spark, sf_dir, "customer").select(
        key.alias("customer_key"),
        F.when(key % 4 == 0, F.concat(F.lit("SC"), text))
        .when(key % 4 == 1, text)
        .when(key % 4 == 2, (key + 100000000).cast("string"))
        .alias("companyno"),
    )


def listed_quotes(w: Warehouse) -> DataFrame:
    """A list of override quotes that grows with the tables: those with a cancelled agreement, repeats included."""
    cancelled = w.contracts.where("agreement_cancelled_flag = 'Y' and contract_reference is not null")
    return cancelled.select("contract_reference")


def with_bad_keys(rows: DataFrame, key: str) -> DataFrame:
    """``rows`` whose ``key`` is no date any more in February (a month 13) and July (no day)."""
    part = lambda start, length: F.substring(key, start, length)
    bad = F.when(part(5, 2) == "02", F.concat(part(1, 4), F.lit("13"), part(7, 2))).when(part(5, 2) == "07", part(1, 6))
    return rows.withColumn(key, bad.otherwise(F.col(key)))


def derive(spark: SparkSession, sf_dir: str, costs_apart: bool = False) -> Warehouse:
    """The six tables at ``sf_dir``, lazily. ``costs_apart`` is for plans that read the costs in a job of their own."""
    lines, shared = _lines(spark, sf_dir), _lines(spark, sf_dir, shared=True)
    return Warehouse(
        contracts=_contracts(spark, sf_dir),
        costs=_costs(lines if costs_apart else shared),
        daily=_daily(shared),
        settlement=_settlement(lines),
        monthly=_monthly(lines),
        customers=_customers(spark, sf_dir),
    )
