"""Quotes that are reported whatever their quote model says: a few literals, or a frame of any length.

The test for them stands beside others in an OR, so a frame cannot simply filter. It marks instead: the
distinct list is joined from the left, which repeats no row, and a match is a mark. A listed quote may
have any share of the rows; only the list has one row per quote, so AQE may split the other side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridtally.functions.predicates import is_override
from gridtally.storage import free_name

QUOTE = "contract_reference"

# Literals, or a frame with the column ``contract_reference``. Repeats add nothing, a null raises.
Overrides = Sequence[str] | DataFrame


def mark_overrides(rows: DataFrame, overrides: Overrides, mark: str) -> DataFrame:
    """``rows`` plus the column ``mark``: true for overridden quotes; false or null for the others."""
    if not isinstance(overrides, DataFrame):
        return rows.withColumn(mark, is_override(F.col(QUOTE), _literals(overrides)))
    listed = free_name("_listed", rows)
    marked = rows.join(_list(overrides, listed), F.col(QUOTE) == F.col(listed), "left")
    return marked.withColumn(mark, F.col(listed).isNotNull()).drop(listed)


def only_overrides(rows: DataFrame, overrides: Overrides) -> DataFrame:
    """The rows of overridden quotes."""
    if not isinstance(overrides, DataFrame):
        return rows.where(is_override(F.col(QUOTE), _literals(overrides)))
    listed = free_name("_listed", rows)
    return rows.join(_list(overrides, listed), F.col(QUOTE) == F.col(listed), "left_semi")


def _list(overrides: DataFrame, name: str) -> DataFrame:
    known = F.coalesce(QUOTE, F.raise_error(F.lit("overrides hold a null contract_reference")))
    return overrides.select(known.alias(name)).distinct()


def _literals(overrides: Sequence[str]) -> list[str]:
    if any(quote is None for quote in overrides):
        raise ValueError("overrides hold a null contract_reference")
    return list(overrides)
