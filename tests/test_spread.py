"""Ranks of groups of any size, distinct rows by hash, key filters, merged intervals."""

import random
from datetime import datetime, timedelta

import pytest
from helpers import spark_multiset
from pyspark.sql import Window
from pyspark.sql import functions as F
from test_plans import executed, loaded  # noqa: F401

from fixtures.warehouse import CONTRACT_PARAMS, RENEWABLE_PARAMS, WINDOW, derive
from gridtally import contract_month_volumes
from gridtally.operators import contracts, daily, distinct, key_filter, latest, ranks, selection, small_sides
from gridtally.plans import actual_volumes, forecast_volumes


@pytest.fixture(scope="module")
def tables(spark, sf_medium):
    return derive(spark, sf_medium)


# Ranks.

RANKED = "g string, n int, k string, extra int"


def _drawn(size, seed):
    rng = random.Random(seed)
    groups = [None] * 20 + [f"g{i}" for i in range(40)]
    return [(rng.choice(groups), rng.choice([None, *range(9)]), f"k{rng.randrange(50)}", rng.randrange(3)) for _ in range(size)]


def _both(rows, ranges, monkeypatch=None):
    order = [F.col("n").desc_nulls_first(), F.col("k").desc_nulls_last()]
    total = Window.partitionBy("g").orderBy(*order, *(F.col(c).asc_nulls_first() for c in rows.columns))
    spread = ranks.spread_row_number(rows, F.col("g"), order, "number", ranges)
    return spread, rows.withColumn("number", F.row_number().over(total))


@pytest.mark.parametrize("ranges", [1, 2, 7, 64])
def test_spread_numbers_equal_the_window(spark, ranges):
    rows = spark.createDataFrame(_drawn(2000, ranges) + [("g1", 1, "same", 0)] * 300, RANKED).repartition(5)
    spread, window = _both(rows, ranges)
    assert spread.columns == window.columns
    assert spark_multiset(spread) == spark_multiset(window)


def test_spread_numbers_of_few_rows_and_clashing_names(spark):
    rows = spark.createDataFrame([("g", 1, "k", 0)], RANKED)
    for some in (rows, rows.limit(0)):
        spread, window = _both(some, 3)
        assert spark_multiset(spread) == spark_multiset(window)
    named = spark.createDataFrame(_drawn(200, 1), RANKED).withColumns({n: F.lit("own") for n in ("_group", "_range", "_copies", "_before")})
    spread, window = _both(named, 5)
    assert spark_multiset(spread) == spark_multiset(window)


def test_a_group_with_a_third_of_all_rows_lies_in_many_ranges(spark, monkeypatch):
    kept = []
    store = ranks.stored
    monkeypatch.setattr(ranks, "stored", lambda frame: kept.append(store(frame)) or kept[-1])
    rows = spark.range(30_000).selectExpr(
        "if(id % 3 = 0, null, concat('g', id % 5000)) as g", "int(id % 7) as n", "string(id) as k", "0 as extra"
    )
    spread, window = _both(rows, 30)
    assert spread.exceptAll(window).count() == 0 and spread.count() == 30_000
    sizes = {r._range: r["count"] for r in kept[0].groupBy("_range").count().collect()}
    assert max(sizes.values()) < 2 * 30_000 / 30
    assert kept[0].where("_group is null").select("_range").distinct().count() >= 9


def test_spread_agreements_equal_the_window(tables):
    ranked = contracts.ranked_agreements(tables.contracts, tables.monthly, WINDOW)
    spread = contracts.ranked_agreements(tables.contracts, tables.monthly, WINDOW, spread=True)
    assert spread.columns == ranked.columns and spark_multiset(spread) == spark_multiset(ranked)


# Distinct by hash.


def test_distinct_by_hash_on_forced_collisions(spark):
    rng = random.Random(4)
    rows = [(rng.choice([None, "a", "b"]), rng.choice([None, *range(30)])) for _ in range(900)]
    frame = spark.createDataFrame(rows, "s string, n int").repartition(6)
    wanted = spark_multiset(frame.distinct())
    for hashes in (None, [F.lit(1)], [F.coalesce(F.col("n"), F.lit(0)) % 4, F.lit(0)], [F.lit(None).cast("long")]):
        assert spark_multiset(distinct.distinct_by_hash(frame, hashes)) == wanted
    assert distinct.distinct_by_hash(frame.limit(0)).count() == 0
    named = frame.withColumn("_hash0", F.lit("own")).withColumn("_rows", F.lit(1))
    assert distinct.distinct_by_hash(named).count() == sum(wanted.values())


def test_many_copies_make_a_plain_distinct(spark, monkeypatch):
    frame = spark.range(1000).selectExpr("id % 500 as n")
    assert "Union" in distinct.distinct_by_hash(frame)._jdf.queryExecution().analyzed().toString()
    monkeypatch.setattr(small_sides, "MAX_BROADCAST_BYTES", 100)
    plain = distinct.distinct_by_hash(frame)
    assert "Union" not in plain._jdf.queryExecution().analyzed().toString() and plain.count() == 500


def test_only_possible_copies_are_exchanged(tables):
    mpans = small_sides.prepare_side(selection.select_mpans(tables.costs, CONTRACT_PARAMS))
    deduped = daily.dedup_volumes_by_hash(tables.daily, mpans)
    assert spark_multiset(deduped) == spark_multiset(daily.dedup_volumes(tables.daily, mpans))
    plan = executed(deduped)
    wide = [x for x in plan.splitlines() if "- Exchange hashpartitioning" in x and "fin_rep_period#" in x]
    assert len(wide) == 1  # the distinct of the possible copies
    assert "LeftAnti, BuildRight" in plan[: plan.index(wide[0])]
    assert "LeftSemi, BuildRight" in plan[plan.index(wide[0]) :]


# Key filters.


def test_wanted_keys_always_pass(spark):
    rows = spark.range(5000).selectExpr("if(id % 50 = 0, null, concat('c', id % 700)) as c", "if(id % 40 = 0, null, id % 9) as d", "id as _place")
    wanted = rows.where("_place % 331 = 0")
    for bits in (64, 4096, 1 << 20):
        passed = key_filter.pass_filter(rows, key_filter.key_filter(wanted, ["c", "d"], bits), ["c", "d"], bits)
        assert passed.columns == rows.columns
        kept = {r._place for r in passed.collect()}
        keys = {(r.c, r.d) for r in wanted.collect()}
        exact = {r._place for r in rows.collect() if (r.c, r.d) in keys}
        assert exact <= kept and (bits < 1 << 20 or len(kept) <= len(exact) + 40)
    assert key_filter.key_filter(rows, ["_place"], 64).count() == 1  # never more rows than words
    assert key_filter.pass_filter(rows, key_filter.key_filter(wanted.limit(0), ["c"]), ["c"]).count() == 0


def test_flags_of_few_points_read_few_rows(tables):
    mpans = selection.select_mpans(tables.costs, CONTRACT_PARAMS)
    few = small_sides.prepare_side(mpans.orderBy("quote_mpan").limit(20))
    reduced = daily.rows_of_needed_days(tables.daily, few)
    assert reduced.count() < tables.daily.count() / 20
    plan = executed(daily.ltf_flag(reduced))
    below = plan[plan.index("partial_bool_and" if "partial_bool_and" in plan else "partial_min") :]
    assert "BroadcastHashJoin" in below
    for points in (few, mpans):
        plain = spark_multiset(contract_month_volumes(tables, CONTRACT_PARAMS, points))
        filtered = contract_month_volumes(tables, CONTRACT_PARAMS, points, few_points=True, few_copies=True)
        assert spark_multiset(filtered) == plain and plain


# Newest values.


def test_newest_values_by_day_need_no_sorted_aggregate(loaded):  # noqa: F811
    plan = executed(contract_month_volumes(loaded, CONTRACT_PARAMS, newest_by_day=True))
    assert "SortAggregate" not in plan
    assert "SortAggregate" in executed(contract_month_volumes(loaded, CONTRACT_PARAMS))


def test_newest_values_by_day_of_odd_rows(spark):
    rng = random.Random(8)
    days = [None, *(datetime(2023, 1, 1 + n).date() for n in range(4))]
    key = lambda: rng.choice([None, "a", "b", "c"])
    rows = [
        (rng.choice([None, "p", "q", "r"]), rng.choice(days), key(), key(), key(), key(), rng.choice([None, "Y", "N"]), rng.choice([None, *days]))
        for _ in range(300)
    ]
    rows += [("lone", None, "a", None, None, None, None, None), ("never", days[1], "a", "a", "a", "a", "N", None)]
    names = "quote_mpan string, delivery_date date, " + ", ".join(f"{k} string" for k in latest.KEYS)
    frame = spark.createDataFrame(rows, names + ", agreement_cancelled_flag string, agreement_cancellation_date date")
    for some in (frame.repartition(5), frame.limit(0)):
        plain, by_day = latest.latest_per_point(some), latest.latest_per_point_by_day(some)
        assert spark_multiset(by_day) == spark_multiset(plain.select(*by_day.columns))
    odd = frame.withColumn("agreement_cancelled_flag", F.lit("yes"))
    with pytest.raises(Exception, match="other than Y and N"):
        latest.latest_per_point_by_day(odd).collect()


# Merged intervals.


def _day(n):
    return datetime(2023, 1, 1) + timedelta(days=n)


@pytest.mark.parametrize("seed", range(3))
def test_merged_intervals_cover_the_same_days_once(spark, seed):
    rng = random.Random(seed)
    terms = []
    for _ in range(400):
        start = rng.randrange(200)
        end = start + rng.randrange(-3, 25)
        key = rng.choice([None, *"abcdefgh"])
        terms.append((key, rng.choice([None, _day(start), _day(start)]), rng.choice([None, *[_day(end)] * 5])))
    frame = spark.createDataFrame(terms, "contract_key string, valid_from timestamp_ntz, valid_to timestamp_ntz")
    merged = [tuple(r) for r in contracts.merged_validity(frame.repartition(4)).collect()]
    inside = lambda rows, key, day: sum(k == key and None not in (f, t) and f <= day <= t for k, f, t in rows)
    for key in (None, *"abcdefgh"):
        for n in range(-1, 230):
            hits = inside(merged, key, _day(n))
            assert hits == (inside(terms, key, _day(n)) > 0)
    assert contracts.merged_validity(frame.limit(0)).count() == 0


def test_plans_admit_each_volume_once(spark, tables):
    for admitted in (
        actual_volumes.admitted_contracts(tables, RENEWABLE_PARAMS),
        forecast_volumes.admitted_contracts(tables, RENEWABLE_PARAMS),
    ):
        other = admitted.withColumnsRenamed({"valid_from": "f", "valid_to": "t", "contract_key": "c"})
        meet = (F.col("contract_key") == F.col("c")) & (F.col("valid_from") <= F.col("t")) & (F.col("f") <= F.col("valid_to"))
        assert admitted.join(other, meet).count() == admitted.count() > 0
