"""Dates held as ``yyyyMMdd`` text and as year / month integers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_date_key(key: Column) -> Column:
    """Date of a ``yyyyMMdd`` key; a malformed key raises under ANSI mode."""
    return F.to_date(key.cast("string"), "yyyyMMdd")


def is_bad_date_key(key: Column) -> Column:
    """Whether a key is there but is no ``yyyyMMdd`` date, so that ``parse_date_key`` would raise."""
    return key.isNotNull() & F.try_to_date(key.cast("string"), "yyyyMMdd").isNull()


def calendar_month_key(key: Column) -> Column:
    """The ``yyyyMM`` part of a ``yyyyMMdd`` key."""
    return F.substring(key.cast("string"), 1, 6)


def month_start(year: Column, month: Column) -> Column:
    """Midnight of the month's first day. Zone-free, like the agreement dates it is compared with."""
    return F.make_date(year, month, F.lit(1)).cast("timestamp_ntz")
