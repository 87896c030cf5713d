"""Quoted and reforecast MWh per contract, meter and calendar month."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridtally.functions.volumes import REPORT_MWH
from gridtally.operators.contracts import contract_effective_dates
from gridtally.operators.daily import (
    AGREEMENT,
    DAY_KEYS,
    POINTS,
    QUOTED,
    REFORECAST,
    VOLUMES,
    choose_volumes,
    contract_day_parts,
    cut_volumes,
    dedup_volumes,
    dedup_volumes_by_hash,
    rows_of_needed_days,
    with_contract_days,
)
from gridtally.operators.latest import attach_latest, latest_per_point, latest_per_point_by_day
from gridtally.operators.monthly import volumes_to_mwh
from gridtally.operators.selection import select_mpans
from gridtally.params import ContractVolumeParams
from gridtally.sources.warehouse import Warehouse

MONTH_KEYS = (
    *(key for key in DAY_KEYS if key != "delivery_date"),
    "agreement_cancelled_flag",
    "agreement_cancellation_date",
)

_MWH_NAMES = {
    **{kwh: f"quoted_{point}_volume_mwh" for point, kwh in zip(POINTS, QUOTED)},
    **{kwh: f"reforecasted_{point}_volume_mwh" for point, kwh in zip(POINTS, REFORECAST)},
}


def contract_month_volumes(
    warehouse: Warehouse,
    params: ContractVolumeParams = ContractVolumeParams(),
    mpans: DataFrame | None = None,
    few_points: bool = False,
    few_copies: bool = False,
    laid_out: bool = False,
    newest_by_day: bool = False,
    by_month: bool = False,
) -> DataFrame:
    """24 columns: 11 keys, supply point, 6 volumes, 6 newest values of the supply point.

    Differs from chaining the operators one by one in three ways that leave the result as it is. Flags
    and agreements come by one join. The daily sum is left out, since sums of sums equal one sum and the agreement cut depends only on
    contract and day. The newest keys are found after the monthly sum, from each month's last day:
    the other columns they need are constant within a month row. ``mpans`` is ``select_mpans`` of the same
    parameters if the caller has prepared it.

    Two more ways to exchange less where they pay, which is where ``mpans`` is small: ``few_points`` leaves
    out the flags of contract-days that no selected point has, ``few_copies`` exchanges only rows that may be
    copies (and runs a job to find them). With ``by_month`` all rows are dealt, so ``few_copies`` then runs no job and
    saves no exchange, only the comparing of rows without a copy, and both serve any number of points. ``laid_out`` is for a daily fact stored by ``sources.layout``, which is
    then not exchanged before the monthly sum. ``newest_by_day`` finds the newest values by hash aggregates
    alone, for one more join of the months. ``by_month`` deals the daily rows by contract and month once, for all that
    follows up to the monthly sum, and needs ``configure(spark, by_month=True)``. None changes the result.
    """
    mpans = select_mpans(warehouse.costs, params) if mpans is None else mpans
    if few_copies:
        volumes = dedup_volumes_by_hash(warehouse.daily, mpans, by_month)
    else:
        volumes = dedup_volumes(warehouse.daily, mpans, by_month)
    agreements = contract_effective_dates(warehouse.contracts)
    flagged = rows_of_needed_days(warehouse.daily, mpans) if few_points else warehouse.daily
    if by_month:
        dated, undated = (_months(part) for part in contract_day_parts(volumes, flagged, agreements))
        months = dated.unionByName(undated)
    else:
        months = _months(with_contract_days(volumes, flagged, agreements, laid_out))
    # Volumes as they are reported take a third of the bytes of sums where the months are exchanged by supply point.
    # The newest values read the very same rows, so that exchange runs once where they need it too.
    reported = volumes_to_mwh(months, _MWH_NAMES, REPORT_MWH)
    per_point = latest_per_point_by_day if newest_by_day else latest_per_point
    return attach_latest(reported, per_point(reported, day="last_day"), day="last_day").drop("last_day")


def _months(joined: DataFrame) -> DataFrame:
    return (
        cut_volumes(choose_volumes(joined, keep=AGREEMENT))
        .groupBy(*MONTH_KEYS)
        .agg(*(F.sum(name).alias(name) for name in VOLUMES), F.max("delivery_date").alias("last_day"))
    )
