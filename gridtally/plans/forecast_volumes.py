"""Base, short-term and long-term forecast MWh per contract and month for renewable quotes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridtally.functions.dates import month_start
from gridtally.operators.contracts import admit_loose, admit_strict, latest_agreement
from gridtally.operators.monthly import FORECAST_COLUMNS, forecast_sums, per_customer
from gridtally.params import RenewableParams
from gridtally.sources.warehouse import Warehouse


def admitted_contracts(
    warehouse: Warehouse, params: RenewableParams, strict: bool = False
) -> DataFrame:
    """The contracts that may be reported, and when: intervals of a contract do not overlap."""
    agreements = latest_agreement(warehouse.contracts, warehouse.monthly, params.window)
    if strict:
        return admit_strict(agreements, params.overrides, merged=True)
    return admit_loose(
        agreements, warehouse.contracts, params.window, params.overrides, merged=True
    )


def forecast_volumes_renewable(
    warehouse: Warehouse,
    params: RenewableParams = RenewableParams(),
    strict: bool = False,
    admitted: DataFrame | None = None,
) -> DataFrame:
    """16 columns, distinct.

    By default override quotes skip the newest-agreement and date tests; ``strict`` applies both to
    them too. The admission test reads only grouping columns, so it runs before the sums, as a semi
    join that cannot repeat a row. ``admitted`` is ``admitted_contracts`` of the same parameters if the
    caller has prepared it.
    """
    admitted = admitted_contracts(warehouse, params, strict) if admitted is None else admitted
    rows, terms = warehouse.monthly.alias("rows"), admitted.alias("terms")
    in_force = month_start(F.col("rows.year"), F.col("rows.month")).between(
        F.col("terms.valid_from"), F.col("terms.valid_to")
    )
    reported = rows.join(
        terms, (F.col("rows.contract_key") == F.col("terms.contract_key")) & in_force, "left_semi"
    )
    return (
        per_customer(forecast_sums(reported, params.window), warehouse.customers)
        .select(
            "contract_key",
            "customer_key",
            "product_key",
            "generation_key",
            "quote_id",
            "mpan",
            "delivery_month",
            *FORECAST_COLUMNS,
        )
        .distinct()
    )
