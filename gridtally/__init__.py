"""Monthly volume reports for energy supply, as Spark DataFrame operators and three ready plans."""

from gridtally.params import ContractVolumeParams, FiscalWindow, RenewableParams
from gridtally.plans.actual_volumes import actual_volumes_renewable
from gridtally.plans.contract_volumes import contract_month_volumes
from gridtally.plans.forecast_volumes import forecast_volumes_renewable
from gridtally.plans.reports import actual_report, forecast_report
from gridtally.session import configure
from gridtally.sources.warehouse import Warehouse

__all__ = [
    "ContractVolumeParams",
    "FiscalWindow",
    "RenewableParams",
    "Warehouse",
    "actual_report",
    "actual_volumes_renewable",
    "configure",
    "contract_month_volumes",
    "forecast_report",
    "forecast_volumes_renewable",
]
