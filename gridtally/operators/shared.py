"""Rows that a plan uses twice: what makes Spark exchange them once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def as_read(rows: DataFrame, *others: str) -> Column:
    """True for every row, and read from all columns of ``rows`` and the ``others``, which Spark therefore keeps.

    Where values are taken from rows and then joined to the same rows, both sides read the same columns of them in
    this way, so the exchanges under them are equal and run once.
    """
    columns = [*(rows[name] for name in rows.columns), *(F.col(name) for name in others)]
    return F.xxhash64(*columns) >= F.lit(-(2**63))


def as_dealt(condition: Column) -> Column:
    """``condition``, tested after the exchange under it, so that parts of the rows come from one exchange.

    Spark would test it before, and make the rows, and exchange its share of them, for each part anew. It moves nothing
    that hangs on a row's place, as this seems to.
    """
    return F.when(F.monotonically_increasing_id() >= 0, condition)
