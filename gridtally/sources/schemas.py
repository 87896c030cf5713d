"""The six input tables. Only the columns the plans read are declared."""

from __future__ import annotations

from pyspark.sql import types as T

_TEXT = T.StringType()
_INT = T.IntegerType()
_MOMENT = T.TimestampNTZType()
_KWH = T.DecimalType(18, 3)


def _table(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


DIM_ELEC_CONTRACT = _table(
    contract_key=_TEXT,
    contract_reference=_TEXT,
    agreement_number=_INT,
    agreement_start_date=_MOMENT,
    agreement_end_date=_MOMENT,
    agreement_cancelled_flag=_TEXT,
    agreement_cancellation_date=_MOMENT,
    quote_model=_TEXT,
)

DIM_CUSTOMER = _table(customer_key=_TEXT, companyno=_TEXT)

FACT_COST_MONTHLY = _table(
    quote_mpan=_TEXT,
    costcomponent_key=_TEXT,
    year=_INT,
    contract_won_date_key=_TEXT,
)

FACT_CONSUMPTION_DAILY = _table(
    contract_key=_TEXT,
    contract_reference=_TEXT,
    meter_key=_TEXT,
    customer_key=_TEXT,
    product_key=_TEXT,
    quote_mpan=_TEXT,
    delivery_date_key=_TEXT,
    contract_won_date_key=_TEXT,
    fin_rep_period=_TEXT,
    snapshot_date=_TEXT,
    itron_forecast_key_lt=_TEXT,
    nbp_volume_kwh=_KWH,
    gsp_volume_kwh=_KWH,
    site_volume_kwh=_KWH,
    reforecasted_nbp_volume_lt=_KWH,
    reforecasted_gsp_volume_lt=_KWH,
    reforecasted_msp_volume_lt=_KWH,
)

FACT_CONSUMPTION_MONTHLY = _table(
    contract_key=_TEXT,
    contract_reference=_TEXT,
    customer_key=_TEXT,
    product_key=_TEXT,
    meter_key=_TEXT,
    quote_mpan=_TEXT,
    mpan=_TEXT,
    year=_INT,
    month=_INT,
    site_volume_kwh=_KWH,
    gsp_volume_kwh=_KWH,
    nbp_volume_kwh=_KWH,
    reforecasted_msp_volume_st=_KWH,
    reforecasted_gsp_volume_st=_KWH,
    reforecasted_nbp_volume_st=_KWH,
    reforecasted_msp_volume_lt=_KWH,
    reforecasted_gsp_volume_lt=_KWH,
    reforecasted_nbp_volume_lt=_KWH,
)

FACT_SETTLEMENT_MONTHLY = _table(
    meter_key=_TEXT,
    mpan=_TEXT,
    meter_type=_TEXT,
    measurement_quantity_id=_TEXT,
    actual_estimate_indicator=_TEXT,
    year=_INT,
    month=_INT,
    settlement_site_volume_kwh=_KWH,
    settlement_gsp_volume_kwh=_KWH,
    settlement_nbp_volume_kwh=_KWH,
)
