"""Relations between operators that hold on any data, checked on the whole test tables."""

import pytest
from helpers import spark_multiset
from pyspark.sql import functions as F

import __spark_entry__ as entry_module
from fixtures.warehouse import CONTRACT_PARAMS, RENEWABLE_PARAMS, WINDOW, derive
from gridtally import contract_month_volumes, forecast_volumes_renewable
from gridtally.functions.predicates import overlaps_window
from gridtally.operators import contracts, daily, latest, monthly, selection


@pytest.fixture(scope="module")
def tables(spark, sf_small):
    return derive(spark, sf_small)


def _clean(w):
    return daily.dedup_volumes(w.daily, selection.select_mpans(w.costs, CONTRACT_PARAMS))


def test_one_join_gives_what_the_two_give(tables):
    volumes = _clean(tables)
    contract = contracts.contract_effective_dates(tables.contracts)
    chosen = daily.reforecast_fallback(volumes, daily.ltf_flag(tables.daily))
    by_two = daily.zero_outside_agreement(chosen, contract)
    joined = daily.with_contract_days(volumes, tables.daily, contract)
    by_one = daily.cut_volumes(daily.choose_volumes(joined, keep=daily.AGREEMENT))
    assert spark_multiset(by_two) == spark_multiset(by_one)


def test_a_row_without_a_day_meets_its_contract(tables):
    a_day = tables.daily.where("contract_key is not null").limit(40)
    undated = a_day.withColumn("delivery_date_key", F.lit(None).cast(dict(a_day.dtypes)["delivery_date_key"]))
    source = tables.daily.union(undated)
    volumes = daily.dedup_volumes(source, source.select("quote_mpan").distinct())
    contract = contracts.contract_effective_dates(tables.contracts)
    chosen = daily.reforecast_fallback(volumes, daily.ltf_flag(source))
    joined = daily.with_contract_days(volumes, source, contract)
    by_one = daily.cut_volumes(daily.choose_volumes(joined, keep=daily.AGREEMENT))
    assert volumes.where("delivery_date_key is null").count()
    assert spark_multiset(daily.zero_outside_agreement(chosen, contract)) == spark_multiset(by_one)


def test_plan_equals_the_chained_operators(tables):
    contract = contracts.contract_effective_dates(tables.contracts)
    chosen = daily.reforecast_fallback(_clean(tables), daily.ltf_flag(tables.daily))
    rows = latest.latest_keys(
        daily.zero_outside_agreement(daily.daily_rollup(chosen), contract)
    )
    keys = [c for c in rows.columns if c not in (*daily.VOLUMES, "delivery_date")]
    chained = monthly.volumes_to_mwh(
        rows.groupBy(*keys).agg(*(F.sum(v).alias(v) for v in daily.VOLUMES)),
        {
            v: v.replace("_volume_kwh", "_volume_mwh")
            if v in daily.REFORECAST
            else "quoted_" + v.replace("_volume_kwh", "_volume_mwh")
            for v in daily.VOLUMES
        },
        "decimal(10,2)",
    )
    assert spark_multiset(chained) == spark_multiset(
        contract_month_volumes(tables, CONTRACT_PARAMS)
    )


def test_the_agreement_cut_leaves_quoted_totals(tables):
    rolled = daily.daily_rollup(
        daily.reforecast_fallback(_clean(tables), daily.ltf_flag(tables.daily))
    )
    cut = daily.zero_outside_agreement(
        rolled, contracts.contract_effective_dates(tables.contracts)
    )
    totals = [F.sum(v).alias(v) for v in daily.QUOTED]
    assert rolled.agg(*totals).first() == cut.agg(*totals).first()


def test_newest_values_are_constant_per_supply_point(tables):
    rows = contract_month_volumes(tables, CONTRACT_PARAMS)
    newest = [c for c in rows.columns if c.startswith("last_")]
    assert len(newest) == 6
    several = rows.select("quote_mpan", *newest).distinct().groupBy("quote_mpan").count()
    assert several.where("count > 1").count() == 0


def test_strict_is_a_subset_of_loose(spark, sf_medium):
    tables = derive(spark, sf_medium)
    strict = forecast_volumes_renewable(tables, RENEWABLE_PARAMS, strict=True)
    loose = forecast_volumes_renewable(tables, RENEWABLE_PARAMS)
    assert strict.exceptAll(loose).count() == 0
    assert strict.count() < loose.count()


def test_supplies_repeated_over_months_add_nothing(tables):
    """The readings meet each supply once, however many months the monthly fact lists."""
    thick = tables.monthly.unionByName(tables.monthly.withColumn("month", F.lit(1)))
    once = monthly.settled_months(tables.settlement, tables.monthly, tables.customers, WINDOW)
    again = monthly.settled_months(tables.settlement, thick, tables.customers, WINDOW)
    assert spark_multiset(once) == spark_multiset(again)


def test_newest_agreement_equals_the_plain_join(tables):
    """Distinct supply points before the join do not change who ranks first."""
    in_window = tables.contracts.where(
        overlaps_window(F.col("agreement_start_date"), F.col("agreement_end_date"), WINDOW)
    )
    plain = (
        in_window.join(tables.monthly.select("contract_key", "mpan"), "contract_key")
        .groupBy("contract_reference", "mpan")
        .agg(
            F.max(
                F.struct(
                    F.col("agreement_number").isNull(), F.col("agreement_number"), "contract_key"
                )
            )["contract_key"].alias("contract_key")
        )
    )
    newest = contracts.latest_agreement(tables.contracts, tables.monthly, WINDOW)
    assert spark_multiset(newest.select(*plain.columns)) == spark_multiset(plain)


def test_reports_are_ordered_and_named(spark, sf_medium):
    for name in ("actual_report", "forecast_report"):
        report = entry_module.queries()[name](spark, sf_medium)
        order = ["Contract Key", "Generation Key", "Delivery Month"]
        rows = [tuple(r) for r in report.select(*order).collect()]
        assert rows and rows == sorted(rows)
