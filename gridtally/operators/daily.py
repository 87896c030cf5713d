"""Daily volumes: clean rows, choose between reforecast and quoted volumes, cut at the agreement."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridtally.functions.dates import calendar_month_key, parse_date_key
from gridtally.functions.volumes import KWH, zero_if_null
from gridtally.operators.distinct import distinct_by_hash
from gridtally.operators.key_filter import BITS, key_filter, pass_filter, same_type, semi_join_by_filter
from gridtally.operators.rejects import Checked, check_date_keys
from gridtally.operators.selection import ROW_KEYS, mpan_semi_join, not_null_keys
from gridtally.operators.shared import as_read

POINTS = ("nbp", "gsp", "msp")
QUOTED = tuple(f"{point}_volume_kwh" for point in POINTS)
REFORECAST = tuple(f"reforecasted_{point}_volume_kwh" for point in POINTS)
VOLUMES = QUOTED + REFORECAST

CONTRACT_DAY = ("contract_key", "delivery_date_key")

# With ``by_month`` daily rows are dealt by these once, for copies, flags, sums and agreements. A hot contract is spread
# over its months. ``session.configure(spark, by_month=True)`` lets joins and aggregates rely on it.
CONTRACT_MONTH = ("contract_key", "calendarmonthkey")

AGREEMENT = (
    "agreement_start_date",
    "agreement_end_date",
    "agreement_cancelled_flag",
    "agreement_cancellation_date",
)

DAY_KEYS = (
    "contract_key",
    "quote",
    "meter_key",
    "customer_key",
    "product_key",
    "delivery_date",
    "calendarmonthkey",
    "contract_won_date",
    "fin_rep_period",
    "snapshot_date",
    "quote_mpan",
)


def ltf_flag(daily: DataFrame) -> DataFrame:
    """Per contract and day: 'Y' if every row has a long-term forecast key, else 'N'.

    Counts all supply points of the contract, so never filter ``daily`` by supply point first.
    A boolean minimum is used since it fits a hash aggregate, which a text minimum does not.
    """
    complete = F.bool_and(F.col("itron_forecast_key_lt").isNotNull())
    return (
        not_null_keys(daily, ["contract_key"])
        .groupBy(*CONTRACT_DAY)
        .agg(F.when(complete, "Y").otherwise("N").alias("has_ltf"))
    )


def dedup_volumes(daily: DataFrame, mpans: DataFrame, by_month: bool = False) -> DataFrame:
    """Distinct daily rows of the selected supply points.

    Distinct runs on the raw columns with a partial pass before the shuffle, so a row copied many
    times is collapsed where it is read; dates are parsed afterwards, once per kept row.

    With ``by_month`` the rows are dealt by ``CONTRACT_MONTH`` instead, copies included. The points then are found by
    ``semi_join_by_filter``, so that is the only exchange of the rows, however many points are selected.
    """
    if not by_month:
        return _with_dates(_wide_rows(daily, mpans).distinct())
    return _with_dates(_rows_with_month(daily, mpans).repartition(*CONTRACT_MONTH).distinct())


def dedup_volumes_by_hash(daily: DataFrame, mpans: DataFrame, by_month: bool = False) -> DataFrame:
    """``dedup_volumes`` where copies are rare: only rows that may be copies are exchanged.

    Runs a job that counts 128-bit hashes of the rows. ``daily`` is then read once for the rows without a
    copy and once for the others, so ``mpans`` should be small enough to be broadcast.

    With ``by_month`` the result is dealt by ``CONTRACT_MONTH``, by the only exchange of the rows, however many copies
    there are and points are selected. No job is run then.
    """
    if not by_month:
        return _with_dates(distinct_by_hash(_wide_rows(daily, mpans)))
    return _with_dates(distinct_by_hash(_rows_with_month(daily, mpans), deal=CONTRACT_MONTH))


def dedup_volumes_lenient(daily: DataFrame, mpans: DataFrame) -> Checked:
    """``dedup_volumes`` of the rows whose date keys can be read, and the other rows of these points.

    Rows count one by one, copies included. Runs a job that stores the columns read of the rows of the
    selected supply points.
    """
    checked = check_date_keys(_wide_rows(daily, mpans), ["delivery_date_key", "contract_won_date_key"])
    return Checked(_with_dates(checked.accepted.distinct()), checked.rejected)


def _wide_rows(daily: DataFrame, mpans: DataFrame) -> DataFrame:
    return _volume_columns(mpan_semi_join(not_null_keys(daily), mpans))


def _rows_with_month(daily: DataFrame, mpans: DataFrame) -> DataFrame:
    """``_wide_rows`` with their month, and without an exchange of them, however many points there are."""
    selected = semi_join_by_filter(not_null_keys(daily), mpans, "quote_mpan")
    return _volume_columns(selected).withColumn("calendarmonthkey", calendar_month_key(F.col("delivery_date_key")))


def _volume_columns(rows: DataFrame) -> DataFrame:
    return rows.select(
        "contract_key",
        F.col("contract_reference").alias("quote"),
        "meter_key",
        "customer_key",
        "product_key",
        "delivery_date_key",
        "contract_won_date_key",
        "fin_rep_period",
        "snapshot_date",
        "quote_mpan",
        "nbp_volume_kwh",
        "gsp_volume_kwh",
        F.col("site_volume_kwh").alias("msp_volume_kwh"),
        *(f"reforecasted_{point}_volume_lt" for point in POINTS),
    )


def _with_dates(rows: DataFrame) -> DataFrame:
    month = calendar_month_key(F.col("delivery_date_key")).alias("calendarmonthkey")
    return rows.select(
        *(c for c in rows.columns if c not in ("contract_won_date_key", "calendarmonthkey")),
        parse_date_key(F.col("delivery_date_key")).alias("delivery_date"),
        F.col("calendarmonthkey") if "calendarmonthkey" in rows.columns else month,
        parse_date_key(F.col("contract_won_date_key")).alias("contract_won_date"),
    )


def rows_of_needed_days(daily: DataFrame, mpans: DataFrame, bits: int = BITS) -> DataFrame:
    """The rows of ``daily`` on contract-days of selected supply points, and few others.

    Flags count all supply points of a contract, so rows are left out by contract and day, never by supply
    point. The contract-days of the selected points become a bitmap of fixed size, which is broadcast; the
    rows it leaves out are not aggregated or exchanged. That pays where the points are few: their rows are
    read once more. The points, too, are found by a bitmap, so no rows are exchanged for it, however many they are.
    """
    if same_type(daily, mpans, "quote_mpan"):
        points = key_filter(mpans, ["quote_mpan"], bits)
        needed = pass_filter(not_null_keys(daily, [*ROW_KEYS, "quote_mpan"]), points, ["quote_mpan"], bits)
    else:
        needed = mpan_semi_join(not_null_keys(daily), mpans)
    return pass_filter(daily, key_filter(needed, CONTRACT_DAY, bits), CONTRACT_DAY, bits)


def with_contract_days(
    volumes: DataFrame, daily: DataFrame, contract: DataFrame, laid_out: bool = False
) -> DataFrame:
    """``volumes`` with ``has_ltf`` and the agreement columns of ``contract``, by a single join.

    Gives what a left join to ``ltf_flag(daily)`` by contract and day and one to ``contract`` by contract
    would give. The flags, a narrow row per contract and day, meet the contracts first, so the wide
    daily rows are shuffled once, and a hot contract is spread over its days. A row without a day key
    has no flag but meets its contract. Needs ``volumes`` to be rows of ``daily``.

    With ``laid_out`` rows without a day key meet their contract in a join of their own. The others then
    match on plain equality, which buckets by contract and day serve without an exchange.
    """
    day = F.col("delivery_date_key")
    flags = ltf_flag(daily)
    if laid_out:
        dated = volumes.where(day.isNotNull())
        met = _join_days(dated, _days(flags, contract), day == F.col("_day"))
        undated = volumes.where(day.isNull()).withColumn("has_ltf", F.lit(None).cast("string"))
        return met.unionByName(undated.join(contract, "contract_key", "left").select(*met.columns))
    flags = flags.withColumn("has_ltf", F.when(day.isNotNull(), F.col("has_ltf")))
    return _join_days(volumes, _days(flags, contract), day.eqNullSafe(F.col("_day")))


def contract_day_parts(
    volumes: DataFrame, daily: DataFrame, contract: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """``with_contract_days`` of ``volumes`` dealt by ``CONTRACT_MONTH``, which stay where they are.

    In two parts, rows with a day key and rows without, so that sums by month may follow in each.
    """
    day = F.col("delivery_date_key")
    met = _join_months(volumes.where(day.isNotNull()), _days(ltf_flag(daily), contract))
    # Volumes have their contract. Said as for the flags, so that both parts read, and exchange, the same contracts.
    undated = not_null_keys(volumes.where(day.isNull()), ["contract_key"])
    undated = undated.withColumn("has_ltf", F.lit(None).cast("string"))
    return met, undated.join(contract, "contract_key", "left").select(*met.columns)


def _join_months(volumes: DataFrame, days: DataFrame) -> DataFrame:
    """``volumes``, dealt by ``CONTRACT_MONTH``, with the row of ``days`` of their contract and day."""
    dated = days.withColumn("_month", calendar_month_key(F.col("_day"))).repartition("_contract", "_month")
    same_day = (F.col("delivery_date_key") == F.col("_day")) & (F.col("calendarmonthkey") == F.col("_month"))
    return _join_days(volumes, dated, same_day).drop("_month")


def _days(flags: DataFrame, contract: DataFrame) -> DataFrame:
    return flags.join(contract, "contract_key", "left").select(
        F.col("contract_key").alias("_contract"),
        F.col("delivery_date_key").alias("_day"),
        "has_ltf",
        *AGREEMENT,
    )


def _join_days(volumes: DataFrame, days: DataFrame, same_day: Column) -> DataFrame:
    same = (F.col("contract_key") == F.col("_contract")) & same_day
    return volumes.join(days, same, "left").drop("_contract", "_day")


def choose_volumes(flagged: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Long-term reforecast where ``has_ltf`` is 'Y', the quoted volume elsewhere, null as zero.

    A missing reforecast under 'Y' becomes zero; it does not fall back to the quoted volume. The
    columns ``keep`` stay besides the day keys.
    """

    def reforecast(point: str) -> Column:
        chosen = F.when(F.col("has_ltf") == "Y", F.col(f"reforecasted_{point}_volume_lt"))
        return zero_if_null(chosen.otherwise(F.col(f"{point}_volume_kwh")))

    return flagged.select(
        *DAY_KEYS,
        *keep,
        *(zero_if_null(F.col(f"{point}_volume_kwh")).alias(f"{point}_volume_kwh") for point in POINTS),
        *(reforecast(point).alias(f"reforecasted_{point}_volume_kwh") for point in POINTS),
    )


def reforecast_fallback(volumes: DataFrame, ltf: DataFrame, by_month: bool = False) -> DataFrame:
    """``choose_volumes`` after attaching the flags of ``ltf`` by contract and day.

    ``by_month`` is for volumes dealt by ``CONTRACT_MONTH``; the month, which is that of the day, says where rows meet.
    An 'N' says what no flag says, so only the days of a 'Y' are exchanged.
    """
    if by_month:
        day = F.col("delivery_date_key").alias("_day")
        chosen = ltf.where(F.col("has_ltf") == "Y")
        days = chosen.select(F.col("contract_key").alias("_contract"), day, "has_ltf")
        return choose_volumes(_join_months(volumes, days))
    return choose_volumes(volumes.join(ltf, list(CONTRACT_DAY), "left"))


def daily_rollup(volumes: DataFrame) -> DataFrame:
    """Sums of the six volumes per day key."""
    return volumes.groupBy(*DAY_KEYS).agg(*(F.sum(name).alias(name) for name in VOLUMES))


def zero_outside_agreement(
    consumption: DataFrame, contract: DataFrame, by_month: bool = False
) -> DataFrame:
    """Reforecasts become zero on days outside the agreement; quoted volumes are left alone.

    Without a contract row, or with a bound missing that the other does not settle, the test is
    unknown and the reforecast stays. Several rows for one contract repeat the consumption.

    With ``by_month`` the agreements go to the months their contract has consumption in, so consumption that was
    dealt by ``CONTRACT_MONTH`` stays where its sums were made.
    """
    if not by_month:
        return cut_volumes(consumption.join(contract, "contract_key", "left"))
    month = F.col("calendarmonthkey")
    placed = month.isNotNull() & F.col("contract_key").isNotNull()
    dated, undated = consumption.where(placed), consumption.where(~placed)
    months = dated.where(as_read(dated)).select(*CONTRACT_MONTH).distinct()
    terms = months.join(contract, "contract_key", "left").select(
        F.col("contract_key").alias("_contract"), month.alias("_month"), *AGREEMENT
    )
    same = (F.col("contract_key") == F.col("_contract")) & (month == F.col("_month"))
    met = dated.join(terms.repartition("_contract", "_month"), same, "left")
    return cut_volumes(met).unionByName(cut_volumes(undated.join(contract, "contract_key", "left")))


def cut_volumes(joined: DataFrame) -> DataFrame:
    """``zero_outside_agreement`` of consumption that has the agreement columns already."""
    inside = F.col("delivery_date").between(
        F.col("agreement_start_date"), F.col("agreement_end_date")
    )
    none = F.lit(0).cast(KWH)
    return joined.select(
        *DAY_KEYS,
        "agreement_cancelled_flag",
        F.col("agreement_cancellation_date").cast("date").alias("agreement_cancellation_date"),
        *QUOTED,
        *(F.when(~inside, none).otherwise(F.col(name)).alias(name) for name in REFORECAST),
    )
