"""Which supply points and rows a report covers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridtally.functions.dates import parse_date_key
from gridtally.operators.rejects import Checked, check_date_keys
from gridtally.params import ContractVolumeParams

_WON = "contract_won_date_key"

ROW_KEYS = ("contract_key", "meter_key", "customer_key", "product_key")


def not_null_keys(rows: DataFrame, keys: Sequence[str] = ROW_KEYS) -> DataFrame:
    """Rows whose keys are all present."""
    return rows.dropna(subset=list(keys))


def select_mpans(
    costs: DataFrame, params: ContractVolumeParams, excluded: DataFrame | None = None
) -> DataFrame:
    """Distinct supply points billed for the cost component, by year or by the date won.

    A won date is parsed strictly: any malformed key of the component, in a row the year alone does not
    admit, raises. ``excluded`` is a frame whose ``quote_mpan`` is left out besides those of ``params``,
    for lists too long to be literals.
    """
    if any(mpan is None for mpan in params.excluded_mpans):
        raise ValueError("excluded_mpans holds a null, which would exclude every supply point")
    won = parse_date_key(F.col(_WON)).between(params.won_from, params.won_to)
    kept = _billed(costs, params).where(_recent(params) | won)
    if params.excluded_mpans:
        kept = kept.where(~F.col("quote_mpan").isin(list(params.excluded_mpans)))
    points = kept.select("quote_mpan").distinct()
    if excluded is None:
        return points
    known = F.coalesce("quote_mpan", F.raise_error(F.lit("excluded holds a null quote_mpan")))
    listed = excluded.select(known.alias("quote_mpan"))
    return points.join(listed.distinct(), "quote_mpan", "left_anti")


def select_mpans_lenient(
    costs: DataFrame, params: ContractVolumeParams, excluded: DataFrame | None = None
) -> Checked:
    """``select_mpans`` of the rows whose won date can be read, and the other rows of the component.

    A malformed key matters only where ``select_mpans`` would raise: a row that the year admits counts. A
    supply point stays selected if any other of its rows admits it. Runs a job that stores the rows of the
    component.
    """
    read = _billed(costs, params)
    checked = check_date_keys(read, [_WON], needed=~F.coalesce(_recent(params), F.lit(False)))
    return Checked(select_mpans(checked.accepted, params, excluded), checked.rejected)


def _billed(costs: DataFrame, params: ContractVolumeParams) -> DataFrame:
    return costs.where(F.col("costcomponent_key") == params.cost_component).where(
        F.col("quote_mpan").isNotNull()
    )


def _recent(params: ContractVolumeParams) -> Column:
    return F.col("year") >= params.year_from


def mpan_semi_join(rows: DataFrame, mpans: DataFrame) -> DataFrame:
    """Rows of the selected supply points; duplicates in ``mpans`` add nothing."""
    return rows.join(mpans, "quote_mpan", "left_semi")
