"""Parameters of the three plans."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date, datetime

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class FiscalWindow:
    """Inclusive reporting window; ``start`` and ``end`` are wall-clock times without a zone."""

    start: datetime
    end: datetime

    def __post_init__(self) -> None:
        if self.start > self.end:
            raise ValueError(f"window starts after it ends: {self.start} > {self.end}")


# The reporting year April 2023 to March 2024.
FISCAL_2023 = FiscalWindow(datetime(2023, 4, 1), datetime(2024, 3, 31, 23, 59, 59))

# The cost component whose supply points are reported, and the won-date range that
# admits supply points from before the first year.
COST_COMPONENT_KEY = "59b1310dc7b649a054a4c396b7181b73"
COST_YEAR_FROM = 2023
WON_FROM = date(2021, 9, 13)
WON_TO = date(2022, 9, 21)

# Quotes reported as renewable whatever their quote model says.
RENEWABLE_OVERRIDES = (
    "Q00286479", "Q00366719", "Q00346654", "Q00301397", "Q00301429", "Q00680143",
    "Q00698018", "Q00307361", "Q00413840", "Q00335080", "Q00342497",
    "Q00440103", "Q00335033", "Q00367887", "Q00335027", "Q00335071", "Q00410605",
    "Q00335100", "Q00352684", "Q00335041", "Q00440104", "Q00367332", "Q00778757",
    "Q00270944", "Q00275862", "Q00305046",
)


@dataclass(frozen=True)
class ContractVolumeParams:
    """Which supply points the contract-month plan reports."""

    cost_component: str = COST_COMPONENT_KEY
    year_from: int = COST_YEAR_FROM
    won_from: date = WON_FROM
    won_to: date = WON_TO
    excluded_mpans: tuple[str, ...] = field(default=())


@dataclass(frozen=True)
class RenewableParams:
    """Window and override quotes of the settled and forecast plans.

    ``overrides`` may be a frame with the column ``contract_reference`` if they are too many for literals.
    """

    window: FiscalWindow = FISCAL_2023
    overrides: tuple[str, ...] | DataFrame = RENEWABLE_OVERRIDES
