"""Monthly volumes: settled actuals, forecasts, and their match to agreements."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridtally.functions.dates import month_start
from gridtally.functions.keys import generation_key, meter_uid
from gridtally.functions.predicates import in_fiscal_window, settled_meter
from gridtally.functions.volumes import MWH, mwh
from gridtally.params import FiscalWindow

POINTS = ("msp", "gsp", "nbp")

# Forecast output column -> kWh column of the monthly fact.
FORECAST_COLUMNS = {
    "forecast_msp_mwh": "site_volume_kwh",
    "forecast_gsp_mwh": "gsp_volume_kwh",
    "forecast_nbp_mwh": "nbp_volume_kwh",
    **{
        f"forecast_{term}_{point}_mwh": f"reforecasted_{point}_volume_{term}"
        for term in ("st", "lt")
        for point in POINTS
    },
}

# Actual output column -> kWh column of the settlement fact.
ACTUAL_COLUMNS = {
    "actual_msp_mwh": "settlement_site_volume_kwh",
    "actual_gsp_mwh": "settlement_gsp_volume_kwh",
    "actual_nbp_mwh": "settlement_nbp_volume_kwh",
}

FORECAST_KEYS = (
    "contract_key",
    "customer_key",
    "product_key",
    "meter_key",
    "mpan",
    "month",
    "year",
    "contract_reference",
    "quote_mpan",
)


def with_generation_key(rows: DataFrame) -> DataFrame:
    """Rows plus their generation key."""
    key = generation_key(*(F.col(c) for c in ("quote_mpan", "year", "month", "contract_key")))
    return rows.withColumn("generation_key", key)


def with_company_uid(monthly: DataFrame, customers: DataFrame) -> DataFrame:
    """Rows of known customers plus the supply point and company number in one identifier."""
    return monthly.join(customers.select("customer_key", "companyno"), "customer_key").select(
        *(F.col(name) for name in monthly.columns),
        meter_uid(F.col("quote_mpan"), F.col("companyno")).alias("meter_uid"),
    )


def volumes_to_mwh(
    rows: DataFrame, columns: Sequence[str] | dict[str, str], as_type: str = MWH
) -> DataFrame:
    """Rows with kWh columns turned into MWh; a mapping renames them (kWh name to MWh name)."""
    names = columns if isinstance(columns, dict) else {name: name for name in columns}
    return rows.select(
        *(
            mwh(F.col(name), as_type).alias(names[name]) if name in names else F.col(name)
            for name in rows.columns
        )
    )


def settlement_readings(settlement: DataFrame, window: FiscalWindow) -> DataFrame:
    """Distinct actual readings of the window, with their month as ``delivery_month``."""
    year, month = F.col("year"), F.col("month")
    actual = settled_meter(
        F.col("meter_type"), F.col("measurement_quantity_id"), F.col("actual_estimate_indicator")
    )
    readings = (
        settlement.where(actual & in_fiscal_window(year, month, window))
        .select("meter_key", "mpan", "meter_type", "year", "month", *ACTUAL_COLUMNS.values())
        .distinct()
        .withColumn("delivery_month", month_start(year, month))
    )
    return volumes_to_mwh(readings, {kwh: name for name, kwh in ACTUAL_COLUMNS.items()})


def settled_months(
    settlement: DataFrame, monthly: DataFrame, customers: DataFrame, window: FiscalWindow
) -> DataFrame:
    """Actual readings with every contract their meter is supplied under.

    Both sides are made distinct before they meet on the meter, so no pair is made twice and the
    result needs no grouping: readings differ in their own columns, supplies in theirs. The company
    number of the customer is part of the grain, though not of the result: a customer listed under
    two numbers gives two rows.
    """
    supplies = (
        monthly.select(
            "contract_key",
            "customer_key",
            "product_key",
            "contract_reference",
            "quote_mpan",
            "meter_key",
        )
        .distinct()
        .join(customers.select("customer_key", "companyno").distinct(), "customer_key")
        .drop("companyno")
    )
    joined = supplies.join(settlement_readings(settlement, window), "meter_key")
    keyed = with_generation_key(joined).drop("quote_mpan")
    return keyed.withColumnRenamed("contract_reference", "quote_id")


def forecast_sums(monthly: DataFrame, window: FiscalWindow) -> DataFrame:
    """kWh sums per forecast key in the window."""
    return (
        monthly.where(in_fiscal_window(F.col("year"), F.col("month"), window))
        .groupBy(*FORECAST_KEYS)
        .agg(*(F.sum(kwh).alias(kwh) for kwh in FORECAST_COLUMNS.values()))
    )


def per_customer(sums: DataFrame, customers: DataFrame) -> DataFrame:
    """Forecast sums as MWh, once per company number of their customer.

    Summing first and joining the customer after gives the same result on far fewer rows. A customer
    listed n times under one company number counts n times, as it would if joined before the sum.
    """
    listed = customers.groupBy("customer_key", "companyno").agg(
        F.count("*").cast("decimal(9,0)").alias("times")
    )
    scaled = sums.join(listed, "customer_key").select(
        *FORECAST_KEYS,
        month_start(F.col("year"), F.col("month")).alias("delivery_month"),
        *(
            mwh(F.col(kwh) * F.col("times")).alias(name)
            for name, kwh in FORECAST_COLUMNS.items()
        ),
    )
    keyed = with_generation_key(scaled).drop("quote_mpan")
    return keyed.withColumnRenamed("contract_reference", "quote_id")


def forecast_months(
    monthly: DataFrame, customers: DataFrame, window: FiscalWindow
) -> DataFrame:
    """Base, short-term and long-term forecast MWh per contract, meter and month of the window."""
    return per_customer(forecast_sums(monthly, window), customers)


def validity_join(volumes: DataFrame, agreements: DataFrame) -> DataFrame:
    """Volumes whose month starts within an agreement of their contract.

    The match is by contract, so the agreement's supply points are dropped first: otherwise a contract
    that is newest for many of them would repeat each of its volumes that often.
    """
    terms = agreements.select(
        "contract_key",
        "agreement_start_date",
        "agreement_end_date",
        F.col("contract_reference").alias("agreement_quote_id"),
        "quote_model",
    ).distinct()
    return volumes.join(terms, "contract_key").where(
        F.col("delivery_month").between(
            F.col("agreement_start_date"), F.col("agreement_end_date")
        )
    )
