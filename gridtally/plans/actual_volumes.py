"""Settled MWh per contract and month for renewable quotes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridtally.functions.keys import generation_key
from gridtally.operators.contracts import admit_strict, latest_agreement
from gridtally.operators.monthly import ACTUAL_COLUMNS, settlement_readings
from gridtally.params import RenewableParams
from gridtally.sources.warehouse import Warehouse


def admitted_contracts(warehouse: Warehouse, params: RenewableParams) -> DataFrame:
    """The contracts that may be reported, and when: intervals of a contract do not overlap."""
    agreements = latest_agreement(warehouse.contracts, warehouse.monthly, params.window)
    return admit_strict(agreements, params.overrides, merged=True)


def actual_volumes_renewable(
    warehouse: Warehouse,
    params: RenewableParams = RenewableParams(),
    admitted: DataFrame | None = None,
) -> DataFrame:
    """10 columns, distinct.

    The admitted contracts cut the supplies down before these meet the readings on the meter, which
    is the one many-to-many join; the agreement dates are part of its condition. Readings of other meters
    are left out before they are made distinct. ``admitted`` is ``admitted_contracts`` of the same
    parameters if the caller has prepared it.
    """
    admitted = admitted_contracts(warehouse, params) if admitted is None else admitted
    supplies = (
        warehouse.monthly.select(
            "contract_key", "customer_key", "contract_reference", "quote_mpan", "meter_key"
        )
        .join(admitted, "contract_key")
        .distinct()
        .join(warehouse.customers.select("customer_key"), "customer_key", "left_semi")
    )
    meters = supplies.select("meter_key").distinct()
    supplied = warehouse.settlement.join(meters, "meter_key", "left_semi")
    readings = settlement_readings(supplied, params.window)
    in_force = F.col("delivery_month").between(F.col("valid_from"), F.col("valid_to"))
    return (
        supplies.join(readings, "meter_key")
        .where(in_force)
        .select(
            "contract_key",
            "customer_key",
            generation_key(
                F.col("quote_mpan"), F.col("year"), F.col("month"), F.col("contract_key")
            ).alias("generation_key"),
            F.col("contract_reference").alias("quote_id"),
            "mpan",
            "meter_type",
            "delivery_month",
            *ACTUAL_COLUMNS,
        )
        .distinct()
    )
