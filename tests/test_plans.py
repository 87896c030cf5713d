"""What Spark makes of the plans: filters and columns at the scan, shuffles, no Python rows."""

import re

import pytest
from pyspark.sql import functions as F

from fixtures.warehouse import CONTRACT_PARAMS, RENEWABLE_PARAMS, WINDOW, derive
from gridtally import (
    Warehouse,
    actual_volumes_renewable,
    configure,
    contract_month_volumes,
    forecast_volumes_renewable,
    storage,
)
from gridtally.operators import contracts, monthly, selection, small_sides
from gridtally.sources.warehouse import TABLES, conform

PLANS = {
    "contract": lambda w: contract_month_volumes(w, CONTRACT_PARAMS),
    "actual": lambda w: actual_volumes_renewable(w, RENEWABLE_PARAMS),
    "strict": lambda w: forecast_volumes_renewable(w, RENEWABLE_PARAMS, strict=True),
    "loose": lambda w: forecast_volumes_renewable(w, RENEWABLE_PARAMS),
}


@pytest.fixture(scope="module")
def loaded(spark, sf_small, tmp_path_factory):
    """Parquet tables, the settlement and monthly facts in year / month folders."""
    root = str(tmp_path_factory.mktemp("warehouse"))
    derived = derive(spark, sf_small)
    for attribute, (name, schema) in TABLES.items():
        writer = conform(getattr(derived, attribute), schema, name).coalesce(1).write
        if attribute in ("settlement", "monthly"):
            writer = writer.partitionBy("year")
        writer.parquet(f"{root}/{name}")
    return Warehouse.from_parquet(spark, root)


@pytest.fixture
def without_broadcast(spark, monkeypatch):
    """As for tables too large to broadcast."""
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {name: spark.conf.get(name, None) for name in names}
    for name in names:
        spark.conf.set(name, "-1")
    yield
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


@pytest.fixture(autouse=True)
def whole_plan_text(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    yield
    spark.conf.unset("spark.sql.maxMetadataStringLength")


def planned(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def executed(df) -> str:
    """The final adaptive plan, after running it."""
    df._jdf.queryExecution().toRdd().count()
    return planned(df).split("== Initial Plan ==")[0]


def scan(plan: str, *columns: str) -> str:
    """The scan line that reads all ``columns``."""
    lines = [line for line in plan.splitlines() if "FileScan" in line]
    found = [line for line in lines if all(f"{c}#" in line.split("Batched")[0] for c in columns)]
    assert found, lines
    return found[0]


@pytest.mark.parametrize("name", PLANS)
def test_no_row_leaves_the_jvm(loaded, name):
    plan = planned(PLANS[name](loaded))
    assert not re.search(r"Python|Arrow|Pandas|MapPartitions|DeserializeToObject", plan)


@pytest.mark.parametrize("name", PLANS)
def test_no_pairwise_joins_and_no_unmeasured_broadcast(loaded, without_broadcast, name):
    plan = planned(PLANS[name](loaded))
    assert not re.search(r"Cartesian|NestedLoop|Broadcast", plan)


def test_supply_point_filters_reach_the_scan(loaded):
    plan = planned(selection.select_mpans(loaded.costs, CONTRACT_PARAMS))
    pushed = scan(plan, "costcomponent_key").split("PushedFilters: ")[1]
    assert "EqualTo(costcomponent_key,59b1)" in pushed
    assert "IsNotNull(quote_mpan)" in pushed


def test_flag_scan_reads_three_columns(loaded, without_broadcast):
    plan = planned(PLANS["contract"](loaded))
    lines = [x for x in plan.splitlines() if "FileScan" in x and "itron_forecast_key_lt#" in x]
    assert lines
    for line in lines:
        assert len(re.findall(r"\w+:", line.split("ReadSchema: ")[1])) == 3


def test_settlement_filters_prune_folders_and_reach_the_scan(loaded):
    plan = planned(monthly.settlement_readings(loaded.settlement, WINDOW))
    line = scan(plan, "meter_type")
    assert re.search(r"PartitionFilters: \[.*year#\d+ >= 1998", line)
    assert "EqualTo(actual_estimate_indicator,A)" in line


def test_newest_agreement_reads_two_columns_of_the_fact(loaded):
    plan = planned(contracts.latest_agreement(loaded.contracts, loaded.monthly, WINDOW))
    line = next(x for x in plan.splitlines() if "FileScan" in x and "mpan#" in x)
    assert len(re.findall(r"\w+:", line.split("ReadSchema: ")[1])) == 2


def test_rank_keeps_one_row_per_task_before_its_shuffle(loaded):
    plan = planned(contracts.latest_agreement(loaded.contracts, loaded.monthly, WINDOW))
    partial = plan.index("1, Partial")
    shuffle = plan.rindex("Exchange hashpartitioning(_w0", 0, partial)
    assert plan.index("1, Final") < shuffle < partial


def test_contract_plan_has_no_window_and_shares_the_month_exchange(loaded, without_broadcast):
    plan = executed(PLANS["contract"](loaded))
    assert "Window" not in plan
    assert "LeftSemi" in plan
    shared = [line for line in plan.splitlines() if "ReusedExchange" in line]
    assert any("calendarmonthkey" in line for line in shared)
    shuffles = [x for x in plan.splitlines() if re.search(r"- Exchange hashpartitioning", x)]
    # Daily rows: supply points, copies, contract-days. Month rows: sums, newest. The rest are supply
    # points, flags and contracts (2 each), their join, and newest values (2).
    assert len(shuffles) == 13
    by_day = [i for i, x in enumerate(shuffles) if "(contract_key#" in x and "coalesce(delivery_date_key#" in x]
    assert len(by_day) == 1
    # Only the narrow side, which comes after its own exchange, is dealt by contract alone.
    side = next(i for i, x in enumerate(shuffles) if "(_contract#" in x)
    alone = [i for i, x in enumerate(shuffles) if re.search(r"hashpartitioning\(contract_key#\d+, \d+\)", x)]
    assert len(alone) == 2 and by_day[0] < side < min(alone)


@pytest.mark.parametrize("name", PLANS)
def test_every_aggregate_is_partial_before_its_shuffle(loaded, without_broadcast, name):
    """Each aggregate or distinct has its own exchange with a partial pass right below it."""
    lines = planned(PLANS[name](loaded)).splitlines()
    depth = [len(re.match(r"[ :+\-]*", line).group()) for line in lines]
    operators = [re.sub(r"^[ :+\-]*(\*\(\d+\) )?", "", line) for line in lines]
    finals = 0
    for i, operator in enumerate(operators):
        if not operator.startswith(("HashAggregate", "SortAggregate")):
            continue
        if "partial_" in operator:
            continue
        below = i + 1
        while operators[below].startswith("Sort "):
            below += 1
        if operators[below].startswith("Exchange hashpartitioning"):
            finals += 1
            under = operators[below + 1]
            assert under.startswith(("HashAggregate", "SortAggregate")), under
        else:
            # The partial pass of a distinct: its parent is the exchange.
            assert operators[i - 1].startswith("Exchange hashpartitioning"), operators[i - 1]
            assert depth[i] > depth[i - 1]
    assert finals >= 3


def test_small_supply_points_spare_the_shuffle_of_all_daily_rows(loaded):
    mpans = small_sides.prepare_side(selection.select_mpans(loaded.costs, CONTRACT_PARAMS))
    plan = planned(contract_month_volumes(loaded, CONTRACT_PARAMS, mpans))
    lines = plan.splitlines()
    semi = [i for i, line in enumerate(lines) if "BroadcastHashJoin" in line and "LeftSemi" in line]
    assert semi
    for i in semi:
        below = lines[i + 1 : i + 5]
        assert any("FileScan" in line for line in below)
        assert not any("- Exchange" in line for line in below)


def test_side_is_broadcast_by_its_measured_size(spark, monkeypatch):
    side = spark.range(1000).selectExpr("lpad(id, 13, '0') AS quote_mpan")
    rows = spark.range(10).selectExpr("lpad(id, 13, '0') AS quote_mpan")
    for limit, marked in [(1000 * 61, True), (1000 * 61 - 1, False)]:
        monkeypatch.setattr(small_sides, "MAX_BROADCAST_BYTES", limit)
        joined = rows.join(small_sides.prepare_side(side), "quote_mpan", "left_semi")
        text = joined._jdf.queryExecution().analyzed().toString()
        assert ("ResolvedHint" in text) == marked
        assert joined.count() == 10


def test_prepared_side_needs_a_shared_folder(spark, monkeypatch):
    class Cluster:
        master = "spark://host:7077"

        @staticmethod
        def getCheckpointDir():
            return "file:/tmp/somewhere"

    class Session:
        sparkContext = Cluster

    with pytest.raises(ValueError, match="one machine"):
        storage.shared_folder(Session)
    storage.shared_folder(spark)
    assert spark.conf.get("spark.checkpoint.dir") in spark.sparkContext.getCheckpointDir()


@pytest.mark.parametrize("name", PLANS)
def test_building_a_plan_starts_no_job(spark, loaded, name):
    spark.sparkContext.setJobGroup(f"build-{name}", "build")
    try:
        PLANS[name](loaded)
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup(f"build-{name}")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_prepared_sides_give_the_same_rows(loaded):
    from helpers import spark_multiset

    from gridtally.plans import actual_volumes, forecast_volumes

    mpans = small_sides.prepare_side(selection.select_mpans(loaded.costs, CONTRACT_PARAMS))
    admitted = small_sides.prepare_side(actual_volumes.admitted_contracts(loaded, RENEWABLE_PARAMS))
    terms = small_sides.prepare_side(forecast_volumes.admitted_contracts(loaded, RENEWABLE_PARAMS))
    prepared = {
        "contract": contract_month_volumes(loaded, CONTRACT_PARAMS, mpans),
        "actual": actual_volumes_renewable(loaded, RENEWABLE_PARAMS, admitted),
        "loose": forecast_volumes_renewable(loaded, RENEWABLE_PARAMS, admitted=terms),
    }
    for name, result in prepared.items():
        assert spark_multiset(result) == spark_multiset(PLANS[name](loaded))


def test_settlement_is_cut_to_supplied_meters_before_its_distinct(loaded, without_broadcast):
    lines = planned(PLANS["actual"](loaded)).splitlines()
    semi = [i for i, line in enumerate(lines) if "LeftSemi" in line and "meter_key" in line]
    assert semi
    assert any("settlement_site_volume_kwh" in line and "FileScan" in line for line in lines[semi[0] :])


def test_fiscal_window_of_any_length(spark):
    from datetime import datetime

    from gridtally import FiscalWindow
    from gridtally.functions.predicates import in_fiscal_window

    months = [(y, m) for y in range(2020, 2026) for m in range(1, 13)]
    df = spark.createDataFrame(months, "year int, month int")
    for first, last in [((2023, 4), (2023, 6)), ((2021, 11), (2024, 2)), ((2023, 4), (2023, 4))]:
        window = FiscalWindow(datetime(*first, 1), datetime(*last, 28))
        kept = df.where(in_fiscal_window(F.col("year"), F.col("month"), window)).collect()
        assert {tuple(r) for r in kept} == {p for p in months if first <= p <= last}


INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


@pytest.fixture
def fresh_sizes(spark):
    spark.conf.unset(INITIAL)
    yield
    spark.conf.unset(INITIAL)


@pytest.mark.parametrize("tib", [1, 10, 100, 1000])
def test_partitions_follow_the_shuffle_at_any_size(spark, fresh_sizes, tib):
    configure(spark, shuffle_bytes=tib * 1024**4)
    assert int(spark.conf.get(INITIAL)) == tib * 4096


def test_small_shuffles_keep_the_partitions_of_the_session(spark, fresh_sizes):
    configure(spark, shuffle_bytes=1)
    assert spark.conf.get(INITIAL, None) is None


def test_large_tables_raise_the_partitions_by_themselves(spark, loaded, fresh_sizes, monkeypatch):
    from gridtally import session

    monkeypatch.setattr(session, "TARGET_PARTITION_BYTES", 1024)
    configure(spark)
    assert spark.conf.get(INITIAL, None) is None
    configure(spark, loaded.daily)
    by_daily = int(spark.conf.get(INITIAL))
    assert by_daily > 100
    session.size_shuffles(loaded.customers)
    assert int(spark.conf.get(INITIAL)) == by_daily
