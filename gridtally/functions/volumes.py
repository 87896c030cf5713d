"""Volume units. Volumes are exact decimals: several plans group by them."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

KWH = "decimal(18,3)"
MWH = "decimal(28,6)"  # holds any sum of KWH values exactly
REPORT_MWH = "decimal(10,2)"

_PER_KWH = Decimal("0.001")


def mwh(kwh: Column, as_type: str = MWH) -> Column:
    """kWh to MWh without binary rounding; a narrower ``as_type`` rounds half up."""
    return (kwh * F.lit(_PER_KWH)).cast(as_type)


def zero_if_null(volume: Column) -> Column:
    return F.coalesce(volume, F.lit(0).cast(KWH))
