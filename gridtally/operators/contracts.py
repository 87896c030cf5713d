"""The contract dimension: effective dates, newest agreements, and which contracts a report admits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridtally.functions.keys import agreement_group
from gridtally.functions.predicates import is_renewable, ntz, overlaps_window
from gridtally.operators.overrides import Overrides, mark_overrides, only_overrides
from gridtally.operators.ranks import spread_row_number
from gridtally.params import FiscalWindow

_OVERRIDE = "_override"


def contract_effective_dates(contracts: DataFrame, by_contract: bool = False) -> DataFrame:
    """Agreement dates, ended early when cancelled.

    The cancellation keeps its time of day: two cancellations on one day are two rows.

    ``by_contract`` deals them by contract before copies are collapsed, so that a join by contract needs no exchange
    of its own. That too relies on ``configure(spark, by_month=True)``.
    """
    cancelled = F.col("agreement_cancelled_flag") == "Y"
    end = F.when(cancelled, F.col("agreement_cancellation_date").cast("date")).otherwise(
        F.col("agreement_end_date").cast("date")
    )
    dates = contracts.select(
        "contract_key",
        F.col("agreement_start_date").cast("date").alias("agreement_start_date"),
        end.alias("agreement_end_date"),
        "agreement_cancelled_flag",
        "agreement_cancellation_date",
    )
    return (dates.repartition("contract_key") if by_contract else dates).distinct()


def agreements_in_window(contracts: DataFrame, window: FiscalWindow) -> DataFrame:
    """Contract rows whose agreement touches the window."""
    return contracts.where(
        overlaps_window(F.col("agreement_start_date"), F.col("agreement_end_date"), window)
    ).select(
        "contract_key",
        "agreement_number",
        "agreement_start_date",
        "agreement_end_date",
        "contract_reference",
        "quote_model",
    )


def ranked_agreements(
    contracts: DataFrame, monthly: DataFrame, window: FiscalWindow, spread: bool = False
) -> DataFrame:
    """All agreements that touch the window, numbered from the newest per quote and supply point.

    An agreement without a number is the newest; ties go to the greatest contract key. The monthly
    fact only tells which supply points a contract has, so its pairs are made distinct before the
    join. The reports only read rank 1, for which a filter on ``row_num`` lets Spark keep one row per
    group and task ahead of the shuffle. All ranks need a sort of each group: in one task, or with
    ``spread`` in as many as the group fills, at the price of a job and two more exchanges. The group of
    rows without a quote or supply point may be a large share of all rows.
    """
    supplied = monthly.select("contract_key", "mpan").distinct()
    rows = agreements_in_window(contracts, window).join(supplied, "contract_key")
    group = agreement_group(F.col("contract_reference"), F.col("mpan"))
    newest_first = [
        F.col("agreement_number").desc_nulls_first(),
        F.col("contract_key").desc_nulls_last(),
        F.col("agreement_start_date").desc_nulls_last(),
        F.col("agreement_end_date").desc_nulls_last(),
        F.col("quote_model").desc_nulls_last(),
        F.col("mpan").desc_nulls_last(),
    ]
    if spread:
        return spread_row_number(rows, group, newest_first, "row_num")
    in_group = Window.partitionBy(group).orderBy(*newest_first)
    return rows.withColumn("row_num", F.row_number().over(in_group))


def latest_agreement(
    contracts: DataFrame, monthly: DataFrame, window: FiscalWindow
) -> DataFrame:
    """The newest agreement per quote and supply point, among those that touch the window.

    The filter on rank 1 keeps a hot group, the null one included, from gathering in one task.
    """
    ranked = ranked_agreements(contracts, monthly, window)
    return ranked.where(F.col("row_num") == 1).drop("row_num")


def renewable_or_override_strict(
    volumes: DataFrame, ranked: DataFrame, overrides: Overrides
) -> DataFrame:
    """Distinct volumes whose contract's newest agreement covers their month and is chosen.

    ``ranked`` is the result of ``ranked_agreements``; chosen is renewable or overridden.
    """
    newest = mark_overrides(ranked.where(F.col("row_num") == 1), overrides, _OVERRIDE)
    return _admitted(volumes, newest.where(_chosen()), _covers_month())


def renewable_or_override_loose(
    volumes: DataFrame, ranked: DataFrame, overrides: Overrides
) -> DataFrame:
    """As ``renewable_or_override_strict``, but an override of any rank admits all months."""
    newest = (F.col("row_num") == 1) & is_renewable(F.col("quote_model")) & _covers_month()
    marked = mark_overrides(ranked, overrides, _OVERRIDE)
    return _admitted(volumes, marked, newest | F.col(_OVERRIDE))


def _chosen() -> Column:
    return is_renewable(F.col("quote_model")) | F.col(_OVERRIDE)


def _covers_month() -> Column:
    return F.col("delivery_month").between(
        F.col("agreement_start_date"), F.col("agreement_end_date")
    )


def _admitted(volumes: DataFrame, agreements: DataFrame, admitted: Column) -> DataFrame:
    terms = agreements.select(
        "contract_key",
        "agreement_start_date",
        "agreement_end_date",
        _OVERRIDE,
        "quote_model",
        "row_num",
    ).distinct()
    return volumes.join(terms, "contract_key").where(admitted).select(*volumes.columns).distinct()


def admit_strict(
    agreements: DataFrame, overrides: Overrides, merged: bool = False
) -> DataFrame:
    """Contracts to report, each within its agreement: newest, and renewable or overridden.

    ``agreements`` is the result of ``latest_agreement``. One row per contract and pair of dates,
    however many supply points the contract is newest for; with ``merged`` their ``merged_validity``.
    """
    terms = _validity(mark_overrides(agreements, overrides, _OVERRIDE).where(_chosen()))
    return merged_validity(terms) if merged else terms.distinct()


def admit_loose(
    agreements: DataFrame,
    contracts: DataFrame,
    window: FiscalWindow,
    overrides: Overrides,
    merged: bool = False,
) -> DataFrame:
    """As ``admit_strict``, but an override escapes the newest and the date test.

    Overridden contracts that touch the window are admitted for all of it, whatever their rank.
    """
    first_month = window.start.replace(day=1, hour=0, minute=0, second=0, microsecond=0)
    always = only_overrides(agreements_in_window(contracts, window), overrides).select(
        "contract_key",
        ntz(first_month).alias("valid_from"),
        ntz(window.end).alias("valid_to"),
    )
    renewable = _validity(agreements.where(is_renewable(F.col("quote_model"))))
    terms = renewable.unionByName(always)
    return merged_validity(terms) if merged else terms.distinct()


def _validity(agreements: DataFrame) -> DataFrame:
    return agreements.select(
        "contract_key",
        F.col("agreement_start_date").alias("valid_from"),
        F.col("agreement_end_date").alias("valid_to"),
    )


def merged_validity(terms: DataFrame) -> DataFrame:
    """``contract_key``, ``valid_from``, ``valid_to``: the same moments, in intervals that do not meet.

    Both ends belong to an interval. A volume lies in at most one interval of its contract, so a join to
    them repeats no volume, however many agreements overlap. Intervals without a begin, without an end or
    that end before they begin hold no moment. The intervals of a contract are first cut to one per begin,
    before the exchange already, so a task sorts at most as many as there are different begins.
    """
    begins = (
        terms.where(F.col("valid_from") <= F.col("valid_to"))
        .groupBy("contract_key", "valid_from")
        .agg(F.max("valid_to").alias("valid_to"))
    )
    earlier = Window.partitionBy("contract_key").orderBy("valid_from")
    covered = F.max("valid_to").over(earlier.rowsBetween(Window.unboundedPreceding, -1))
    apart = F.when(F.col("valid_from") <= covered, 0).otherwise(1)
    numbered = begins.select("*", apart.alias("_apart")).select(
        "*", F.sum("_apart").over(earlier).alias("_interval")
    )
    # Grouping by both keys gives the result an exchange of its own where it is joined, so that AQE may
    # split a hot contract on the other side; the partitioning of the windows would bar that.
    return (
        numbered.groupBy("contract_key", "_interval")
        .agg(F.min("valid_from").alias("valid_from"), F.max("valid_to").alias("valid_to"))
        .drop("_interval")
    )
