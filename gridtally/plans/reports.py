"""Presentation: display names and the final order. Apply last; sorting a large result is not free."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Display names of the report columns.
COMMON_NAMES = {
    "contract_key": "Contract Key",
    "customer_key": "Customer Key",
    "product_key": "Product Key",
    "generation_key": "Generation Key",
    "quote_id": "Quote ID",
    "mpan": "MPAN",
    "meter_type": "Meter Type",
    "delivery_month": "Delivery Month",
}
ACTUAL_NAMES = {
    "actual_msp_mwh": "Actual MSP (MWh)",
    "actual_gsp_mwh": "Actual GSP (MWh)",
    "actual_nbp_mwh": "Actual NBP (MWh)",
}
FORECAST_NAMES = {
    "forecast_msp_mwh": "Forecast MSP Volume (MWh)",
    "forecast_gsp_mwh": "Forecast GSP Volume (MWh)",
    "forecast_nbp_mwh": "Forecast NBP Volume (MWh)",
    "forecast_st_msp_mwh": "Forecast ST MSP Volume (MWh)",
    "forecast_st_gsp_mwh": "Forecast ST GSP Volume (MWh)",
    "forecast_st_nbp_mwh": "Forecast ST NBP Volume (MWh)",
    "forecast_lt_msp_mwh": "Forecast LT MSP Volume (MWh)",
    "forecast_lt_gsp_mwh": "Forecast LT GSP Volume (MWh)",
    "forecast_lt_nbp_mwh": "Forecast LT NBP Volume (MWh)",
}

_ORDER = ("contract_key", "generation_key", "delivery_month")


def ordered(volumes: DataFrame) -> DataFrame:
    return volumes.orderBy(*(F.col(name).asc_nulls_last() for name in _ORDER))


def actual_report(volumes: DataFrame) -> DataFrame:
    """Settled volumes as presented."""
    return ordered(volumes).withColumnsRenamed({**COMMON_NAMES, **ACTUAL_NAMES})


def forecast_report(volumes: DataFrame) -> DataFrame:
    """Forecast volumes as presented."""
    return ordered(volumes).withColumnsRenamed({**COMMON_NAMES, **FORECAST_NAMES})
