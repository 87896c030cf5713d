"""Hand-made rows for the cases where a plausible reading gives another result."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from helpers import frame, warehouse
from pyspark.sql import functions as F

from gridtally import (
    ContractVolumeParams,
    FiscalWindow,
    RenewableParams,
    actual_volumes_renewable,
    contract_month_volumes,
    forecast_volumes_renewable,
)
from gridtally.functions import predicates
from gridtally.functions.keys import company_code, generation_key
from gridtally.functions.volumes import REPORT_MWH, mwh
from gridtally.operators import contracts, daily, latest, monthly, selection
from gridtally.params import COST_COMPONENT_KEY, FISCAL_2023, RENEWABLE_OVERRIDES
from gridtally.sources import schemas
from gridtally.sources.warehouse import conform

OVERRIDE = RENEWABLE_OVERRIDES[0]
PARAMS = RenewableParams()


def agreement(key="c1", quote="Q1", start=datetime(2023, 4, 1), end=datetime(2024, 3, 31), **more):
    return {
        "contract_key": key,
        "contract_reference": quote,
        "agreement_number": 1,
        "agreement_start_date": start,
        "agreement_end_date": end,
        "agreement_cancelled_flag": "N",
        "quote_model": "Fixed Renewable",
        **more,
    }


def month_row(key="c1", year=2023, month=6, **more):
    return {
        "contract_key": key,
        "contract_reference": "Q1",
        "customer_key": "u1",
        "product_key": "p1",
        "meter_key": "t1",
        "quote_mpan": "m1",
        "mpan": "m1",
        "year": year,
        "month": month,
        "site_volume_kwh": 1000,
        **more,
    }


def reading(year=2023, month=6, **more):
    return {
        "meter_key": "t1",
        "mpan": "m1",
        "meter_type": "NHH",
        "actual_estimate_indicator": "A",
        "year": year,
        "month": month,
        "settlement_site_volume_kwh": 1000,
        **more,
    }


def day_row(day="20230601", **more):
    return {
        "contract_key": "c1",
        "contract_reference": "Q1",
        "meter_key": "t1",
        "customer_key": "u1",
        "product_key": "p1",
        "quote_mpan": "m1",
        "delivery_date_key": day,
        "contract_won_date_key": "20230101",
        "itron_forecast_key_lt": "k",
        "nbp_volume_kwh": 1000,
        "reforecasted_nbp_volume_lt": 2000,
        **more,
    }


def cost_row(**more):
    return {
        "quote_mpan": "m1",
        "costcomponent_key": ContractVolumeParams().cost_component,
        "year": 2023,
        "contract_won_date_key": "20230101",
        **more,
    }


CUSTOMER = {"customer_key": "u1", "companyno": "123"}


def q1(spark, days, agreements=()):
    return contract_month_volumes(
        warehouse(spark, costs=[cost_row()], daily=days, contracts=list(agreements))
    ).collect()


# Months are numbers.


def test_months_compare_as_numbers(spark):
    months = [(2023, m) for m in (3, 4, 9, 10, 12)] + [(2024, m) for m in (1, 3, 4, 10)]
    df = spark.createDataFrame(months, "year int, month int")
    kept = df.where(predicates.in_fiscal_window(F.col("year"), F.col("month"), FISCAL_2023))
    assert {tuple(r) for r in kept.collect()} == {
        (2023, 4), (2023, 9), (2023, 10), (2023, 12), (2024, 1), (2024, 3)
    }


def test_text_months_become_numbers_on_load(spark):
    columns = [f.name for f in schemas.FACT_COST_MONTHLY.fields]
    text = spark.createDataFrame([("m1", "k", "2023", "20230101")], columns)
    assert conform(text, schemas.FACT_COST_MONTHLY, "costs").first()["year"] == 2023


# Units and rounding.


def test_integer_kwh_do_not_truncate(spark):
    df = spark.createDataFrame([(1500,)], "kwh int").select(mwh(F.col("kwh")).alias("v"))
    assert df.first()["v"] == Decimal("1.5")


@pytest.mark.parametrize(
    "kwh, expected", [(16777217, "16777.22"), (1005, "1.01"), (-1005, "-1.01"), (1004.999, "1.00")]
)
def test_report_mwh_round_half_up(spark, kwh, expected):
    assert str(q1(spark, [day_row(nbp_volume_kwh=kwh)])[0]["quoted_nbp_volume_mwh"]) == expected


def test_report_mwh_overflow_raises(spark):
    df = spark.createDataFrame([(Decimal(10) ** 12,)], "kwh decimal(18,3)")
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE"):
        df.select(mwh(F.col("kwh"), REPORT_MWH)).collect()


# Overrides under the two filters.


def _override_case(spark):
    return warehouse(
        spark,
        customers=[CUSTOMER],
        contracts=[
            agreement("c1", OVERRIDE, agreement_number=1, end=datetime(2023, 5, 15), quote_model=None),
            agreement("c2", OVERRIDE, agreement_number=2, quote_model=None),
        ],
        monthly=[month_row("c1"), month_row("c2")],
    )


def test_override_escapes_rank_and_dates_by_default(spark):
    rows = forecast_volumes_renewable(_override_case(spark), PARAMS).collect()
    assert sorted(r["contract_key"] for r in rows) == ["c1", "c2"]


def test_override_obeys_rank_and_dates_when_strict(spark):
    rows = forecast_volumes_renewable(_override_case(spark), PARAMS, strict=True).collect()
    assert [r["contract_key"] for r in rows] == ["c2"]


def test_override_still_needs_an_agreement_that_touches_the_window(spark):
    old = agreement("c1", OVERRIDE, start=datetime(2020, 1, 1), end=datetime(2021, 1, 1))
    w = warehouse(spark, customers=[CUSTOMER], contracts=[old], monthly=[month_row("c1")])
    assert forecast_volumes_renewable(w, PARAMS).collect() == []


def test_override_reads_the_quote_of_the_contract_not_of_the_volume(spark):
    w = warehouse(
        spark,
        customers=[CUSTOMER],
        contracts=[agreement("c1", "Q1", quote_model=None)],
        monthly=[month_row("c1", contract_reference=OVERRIDE)],
    )
    assert forecast_volumes_renewable(w, PARAMS).collect() == []


def test_override_covers_a_window_that_starts_within_a_month(spark):
    window = FiscalWindow(datetime(2023, 6, 15), datetime(2023, 7, 15))
    params = RenewableParams(window=window, overrides=(OVERRIDE,))
    w = warehouse(
        spark,
        customers=[CUSTOMER],
        contracts=[agreement("c1", OVERRIDE, quote_model=None)],
        monthly=[month_row("c1", month=m) for m in (5, 6, 7, 8)],
    )
    months = [r["delivery_month"].month for r in forecast_volumes_renewable(w, params).collect()]
    assert sorted(months) == [6, 7]


# Ranks and ties.


def newest(spark, agreements, months):
    w = warehouse(spark, contracts=agreements, monthly=months)
    return contracts.latest_agreement(w.contracts, w.monthly, FISCAL_2023).collect()


def test_agreement_without_number_is_newest(spark):
    rows = newest(
        spark,
        [agreement("c1", agreement_number=9), agreement("c2", agreement_number=None)],
        [month_row("c1"), month_row("c2")],
    )
    assert [r["contract_key"] for r in rows] == ["c2"]


def test_equal_numbers_go_to_the_greatest_contract(spark):
    rows = newest(
        spark,
        [agreement("c1"), agreement("c3"), agreement("c2")],
        [month_row(k) for k in ("c1", "c2", "c3")],
    )
    assert [r["contract_key"] for r in rows] == ["c3"]


def test_missing_mpans_share_one_group(spark):
    rows = newest(
        spark,
        [agreement("c1", "Q1", agreement_number=1), agreement("c2", "Q2", agreement_number=2)],
        [month_row("c1", mpan=None), month_row("c2", mpan=None), month_row("c1", mpan="m1")],
    )
    assert sorted((r["contract_key"], r["mpan"] or "") for r in rows) == [("c1", "m1"), ("c2", "")]


def test_group_text_has_no_delimiter(spark):
    rows = newest(
        spark,
        [agreement("c1", "Q1", agreement_number=1), agreement("c2", "Q11", agreement_number=2)],
        [month_row("c1", mpan="12"), month_row("c2", mpan="2")],
    )
    assert [r["contract_key"] for r in rows] == ["c2"]


def test_contract_newest_for_one_mpan_admits_all_its_mpans(spark):
    w = warehouse(
        spark,
        customers=[CUSTOMER],
        contracts=[agreement("c1", agreement_number=1), agreement("c2", agreement_number=2)],
        monthly=[
            month_row("c1", mpan="m1"),
            month_row("c1", mpan="m2"),
            month_row("c2", mpan="m2"),
        ],
    )
    rows = forecast_volumes_renewable(w, PARAMS, strict=True).collect()
    assert sorted((r["contract_key"], r["mpan"]) for r in rows) == [
        ("c1", "m1"), ("c1", "m2"), ("c2", "m2")
    ]


def test_newest_keys_come_from_one_row(spark):
    tied = [
        day_row(contract_key="c1", meter_key="t9", customer_key="u9", product_key="p9"),
        day_row(contract_key="c2", meter_key="t1", customer_key="u1", product_key="p1"),
    ]
    for row in q1(spark, tied):
        assert [row[f"last_{k}"] for k in latest.KEYS] == ["c2", "t1", "u1", "p1"]


def test_newest_keys_follow_the_day_within_a_month(spark):
    rows = q1(spark, [day_row("20230602", contract_key="c1"), day_row("20230601", contract_key="c2")])
    assert {r["last_contract_key"] for r in rows} == {"c1"}


def test_cancellation_skips_contracts_without_one(spark):
    cancelled = agreement(
        "c1", agreement_cancelled_flag="Y", agreement_cancellation_date=datetime(2023, 6, 20, 8)
    )
    rows = q1(
        spark,
        [day_row("20230601", contract_key="c1"), day_row("20230701", contract_key="c2")],
        [cancelled, agreement("c2")],
    )
    assert {r["last_agreement_cancellation_date"] for r in rows} == {date(2023, 6, 20)}
    assert {r["last_agreement_cancelled_flag"] for r in rows} == {"Y"}
    assert {r["last_contract_key"] for r in rows} == {"c2"}


# Supply point selection.


@pytest.mark.parametrize("excluded", [(), ("m9",)])
def test_missing_mpan_is_never_selected(spark, excluded):
    costs = frame(
        spark,
        schemas.FACT_COST_MONTHLY,
        [cost_row(quote_mpan=None), cost_row(), cost_row(quote_mpan="m9")],
    )
    found = selection.select_mpans(costs, ContractVolumeParams(excluded_mpans=excluded))
    assert {r[0] for r in found.collect()} == {"m1", "m9"} - set(excluded)


def test_null_exclusion_is_rejected(spark):
    costs = frame(spark, schemas.FACT_COST_MONTHLY, [cost_row()])
    with pytest.raises(ValueError, match="null"):
        selection.select_mpans(costs, ContractVolumeParams(excluded_mpans=("m1", None)))


def test_won_dates_are_inclusive(spark):
    keys = ["20210912", "20210913", "20220921", "20220922"]
    costs = frame(
        spark,
        schemas.FACT_COST_MONTHLY,
        [cost_row(quote_mpan=k, year=2022, contract_won_date_key=k) for k in keys],
    )
    found = selection.select_mpans(costs, ContractVolumeParams())
    assert {r[0] for r in found.collect()} == set(keys[1:3])


# Long-term flag and fallback.


def test_one_missing_forecast_key_flags_the_whole_contract_day(spark):
    days = [day_row(), day_row(meter_key="t2", quote_mpan="other", itron_forecast_key_lt=None)]
    assert q1(spark, days)[0]["reforecasted_nbp_volume_mwh"] == Decimal("1.00")
    assert q1(spark, days[:1])[0]["reforecasted_nbp_volume_mwh"] == Decimal("2.00")


def test_missing_reforecast_under_the_flag_is_zero(spark):
    assert q1(spark, [day_row(reforecasted_nbp_volume_lt=None)])[0][
        "reforecasted_nbp_volume_mwh"
    ] == Decimal("0.00")


def test_row_without_a_day_keeps_its_quoted_volume(spark):
    assert q1(spark, [day_row(day=None)])[0]["reforecasted_nbp_volume_mwh"] == Decimal("1.00")


def test_exact_copies_count_once(spark):
    assert q1(spark, [day_row()] * 3)[0]["quoted_nbp_volume_mwh"] == Decimal("1.00")


# Agreement bounds in the daily plan.


@pytest.mark.parametrize(
    "agreements, kept",
    [
        ([], True),
        ([agreement(start=datetime(2023, 6, 1), end=datetime(2023, 6, 1))], True),
        ([agreement(start=datetime(2023, 6, 2))], False),
        ([agreement(start=datetime(2023, 7, 1), end=None)], False),
        ([agreement(start=datetime(2023, 5, 1), end=None)], True),
        ([agreement(start=None, end=datetime(2023, 5, 31))], False),
        ([agreement(start=None, end=None)], True),
        ([agreement(agreement_cancelled_flag="Y")], True),
        (
            [
                agreement(
                    agreement_cancelled_flag="Y",
                    agreement_cancellation_date=datetime(2023, 5, 1),
                )
            ],
            False,
        ),
    ],
)
def test_reforecast_is_cut_only_when_surely_outside(spark, agreements, kept):
    row = q1(spark, [day_row()], agreements)[0]
    assert row["reforecasted_nbp_volume_mwh"] == Decimal("2.00" if kept else "0.00")
    assert row["quoted_nbp_volume_mwh"] == Decimal("1.00")


def test_two_cancellation_times_on_one_day_double_the_volumes(spark):
    twice = [
        agreement(
            agreement_cancelled_flag="Y",
            agreement_cancellation_date=datetime(2023, 12, 1, hour),
        )
        for hour in (8, 9)
    ]
    rows = q1(spark, [day_row()], twice)
    assert [r["quoted_nbp_volume_mwh"] for r in rows] == [Decimal("2.00")]


# Agreements and months.


@pytest.mark.parametrize(
    "start, end, kept",
    [
        (datetime(2023, 6, 1), None, True),
        (None, datetime(2023, 6, 1), True),
        (datetime(2023, 4, 1), datetime(2024, 3, 31, 23, 59, 59), True),
        (datetime(2020, 1, 1), datetime(2030, 1, 1), True),
        (datetime(2020, 1, 1), None, False),
        (datetime(2024, 4, 1), None, False),
        (datetime(2020, 1, 1), datetime(2023, 3, 31, 23, 59, 59), False),
    ],
)
def test_agreement_touches_the_window(spark, start, end, kept):
    df = frame(spark, schemas.DIM_ELEC_CONTRACT, [agreement(start=start, end=end)])
    assert contracts.agreements_in_window(df, FISCAL_2023).count() == int(kept)


def test_month_counts_only_from_its_first_day(spark):
    w = warehouse(
        spark,
        customers=[CUSTOMER],
        contracts=[agreement(start=datetime(2023, 5, 15))],
        monthly=[month_row(month=5), month_row(month=6)],
        settlement=[reading(month=5), reading(month=6)],
    )
    june = datetime(2023, 6, 1)
    assert [r["delivery_month"] for r in forecast_volumes_renewable(w, PARAMS).collect()] == [june]
    assert [r["delivery_month"] for r in actual_volumes_renewable(w, PARAMS).collect()] == [june]


def test_month_bounds_do_not_move_with_the_session_zone(spark):
    w = warehouse(
        spark,
        customers=[CUSTOMER],
        contracts=[agreement(start=datetime(2023, 6, 1), end=datetime(2023, 6, 1))],
        monthly=[month_row()],
        settlement=[reading()],
    )
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        assert forecast_volumes_renewable(w, PARAMS, strict=True).count() == 1
        assert actual_volumes_renewable(w, PARAMS).count() == 1
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_customer_listed_twice_doubles_forecasts_only(spark):
    def plans(copies):
        w = warehouse(
            spark,
            customers=[CUSTOMER] * copies,
            contracts=[agreement()],
            monthly=[month_row()],
            settlement=[reading()],
        )
        forecast = forecast_volumes_renewable(w, PARAMS).collect()
        actual = actual_volumes_renewable(w, PARAMS).collect()
        return [r["forecast_msp_mwh"] for r in forecast], [r["actual_msp_mwh"] for r in actual]

    assert plans(1) == ([Decimal("1.000000")], [Decimal("1.000000")])
    assert plans(2) == ([Decimal("2.000000")], [Decimal("1.000000")])


def test_equal_readings_count_once(spark):
    w = warehouse(
        spark,
        customers=[CUSTOMER],
        contracts=[agreement()],
        monthly=[month_row(month=m) for m in range(4, 13)],
        settlement=[reading()] * 5,
    )
    assert monthly.settled_months(w.settlement, w.monthly, w.customers, FISCAL_2023).count() == 1


# Text and keys.


def test_malformed_day_raises(spark):
    with pytest.raises(Exception, match="CANNOT_PARSE_TIMESTAMP|could not be parsed"):
        q1(spark, [day_row(day="2023040x")])


@pytest.mark.parametrize(
    "companyno, expected",
    [
        ("123", "00000123"),
        ("12345678", "12345678"),
        ("1234567890", "1234567890"),
        ("SC1", "SC1"),
        ("9x", "0000009x"),
        ("", ""),
        (None, ""),
    ],
)
def test_company_codes(spark, companyno, expected):
    df = spark.createDataFrame([(companyno,)], "n string").select(company_code(F.col("n")).alias("v"))
    assert df.first()["v"] == expected


def test_generation_key(spark):
    df = spark.createDataFrame(
        [("m1", 2023, 4, "c1"), ("m1", 2023, 12, "c1"), (None, 2023, 4, "c1")],
        "mpan string, year int, month int, contract string",
    ).select(generation_key(*(F.col(c) for c in ("mpan", "year", "month", "contract"))).alias("v"))
    assert [r["v"] for r in df.collect()] == ["m120230401c1", "m120231201c1", None]


@pytest.mark.parametrize(
    "model, kept",
    [
        ("Fixed Renewable", 1),
        ("Non Renewable", 1),
        ("Fixed No Renewable", 0),
        ("renewable", 0),
        (None, 0),
    ],
)
def test_renewable_models(spark, model, kept):
    df = spark.createDataFrame([(model,)], "m string")
    assert df.where(predicates.is_renewable(F.col("m"))).count() == kept


def test_flag_is_the_minimum_over_all_rows(spark):
    rows = [day_row(), day_row(itron_forecast_key_lt=None), day_row("20230602")]
    df = frame(spark, schemas.FACT_CONSUMPTION_DAILY, [*rows, day_row(contract_key=None)])
    flags = {r["delivery_date_key"]: r["has_ltf"] for r in daily.ltf_flag(df).collect()}
    assert flags == {"20230601": "N", "20230602": "Y"}


# Rows of the second round.


@pytest.mark.parametrize("key", ["x9990101", "1998-12-20", " 19990101", "1999/01/01", "199901"])
def test_malformed_won_key_raises_wherever_it_sorts(spark, key):
    w = warehouse(
        spark,
        costs=[{"quote_mpan": "m1", "costcomponent_key": COST_COMPONENT_KEY, "year": 2000, "contract_won_date_key": key}],
    )
    with pytest.raises(Exception, match="CANNOT_PARSE|INVALID|could not be parsed"):
        selection.select_mpans(w.costs, ContractVolumeParams()).collect()


def test_excluded_supply_points_may_be_a_frame(spark):
    w = warehouse(
        spark,
        costs=[
            {"quote_mpan": f"m{i}", "costcomponent_key": COST_COMPONENT_KEY, "year": 2023} for i in range(4)
        ],
    )
    listed = spark.createDataFrame([("m1",), ("m3",), ("m3",)], "quote_mpan string")
    kept = selection.select_mpans(w.costs, ContractVolumeParams(excluded_mpans=("m0",)), listed)
    assert [r.quote_mpan for r in kept.collect()] == ["m2"]
    with pytest.raises(Exception, match="excluded holds a null"):
        nulls = spark.createDataFrame([(None,)], "quote_mpan string")
        selection.select_mpans(w.costs, ContractVolumeParams(), nulls).collect()


def test_two_company_numbers_give_two_settled_rows(spark):
    w = warehouse(
        spark,
        customers=[{**CUSTOMER, "companyno": "1"}, {**CUSTOMER, "companyno": "2"}, {**CUSTOMER, "companyno": "2"}],
        contracts=[agreement()],
        monthly=[month_row()],
        settlement=[reading()],
    )
    assert monthly.settled_months(w.settlement, w.monthly, w.customers, FISCAL_2023).count() == 2


def test_every_rank_is_numbered(spark):
    w = warehouse(
        spark,
        contracts=[{**agreement(), "contract_key": f"k{n}", "agreement_number": n} for n in (1, 3, 2)],
        monthly=[{**month_row(), "contract_key": f"k{n}"} for n in (1, 2, 3, 3)],
    )
    ranked = contracts.ranked_agreements(w.contracts, w.monthly, FISCAL_2023).collect()
    assert {(r.agreement_number, r.row_num) for r in ranked} == {(3, 1), (2, 2), (1, 3)}
    assert len(ranked) == 3


def test_repeated_customers_are_reported_on_request(spark):
    w = warehouse(spark, customers=[CUSTOMER, CUSTOMER])
    with pytest.raises(ValueError, match="dim_customer lists customer_key"):
        w.check_unique()
    warehouse(spark, customers=[CUSTOMER], contracts=[agreement()]).check_unique()
