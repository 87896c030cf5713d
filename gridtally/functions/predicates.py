"""Row predicates. Each is a boolean Column, so Catalyst can push it to the scan where one allows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from gridtally.params import FiscalWindow


def in_fiscal_window(year: Column, month: Column, window: FiscalWindow) -> Column:
    """Whether a month lies in the window, month numbers compared as integers.

    Written on the bare columns, so it reaches the Parquet reader and prunes year / month folders.
    """
    first, last = window.start, window.end
    not_before = (year > first.year) | ((year == first.year) & (month >= first.month))
    not_after = (year < last.year) | ((year == last.year) & (month <= last.month))
    return year.between(first.year, last.year) & not_before & not_after


def settled_meter(meter_type: Column, quantity_id: Column, indicator: Column) -> Column:
    """Actual readings: active import for half-hourly meters, no quantity for the others."""
    half_hourly = (meter_type == "HH") & (quantity_id == "AI")
    other = (meter_type == "NHH") & quantity_id.isNull()
    return (indicator == "A") & (half_hourly | other)


def overlaps_window(start: Column, end: Column, window: FiscalWindow) -> Column:
    """Agreement starts in, ends in or spans the window.

    Three branches, not ``start <= hi and end >= lo``: an agreement that starts in the window and has
    no end must stay.
    """
    lo, hi = ntz(window.start), ntz(window.end)
    return start.between(lo, hi) | end.between(lo, hi) | ((start <= lo) & (end >= hi))


def is_renewable(quote_model: Column) -> Column:
    """Case-sensitive; 'Non Renewable' counts, 'No Renewable' does not, null is unknown."""
    return quote_model.contains("Renewable") & ~quote_model.contains("No Renewable")


def is_override(contract_reference: Column, overrides: Sequence[str]) -> Column:
    return contract_reference.isin(list(overrides))


def ntz(moment) -> Column:
    """Zone-free timestamp literal."""
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")
