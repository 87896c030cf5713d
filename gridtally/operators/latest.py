"""Values that hold for a whole supply point, attached to each of its rows.

A window over the supply point would sort all rows of one point in a single task. Here each value is
a maximum per point, reduced before the shuffle, and joined back; a hot point then costs one partial
row per task, and AQE splits the join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridtally.operators.shared import as_read

KEYS = ("contract_key", "meter_key", "customer_key", "product_key")

_POINT = "_point"
_NEWEST = "_newest"
_NEWEST_DAY = "_newest_day"


def _recency(day: str) -> list[Column]:
    """Ordering of rows by day, a missing day being last; ties go to the greatest keys."""
    return [F.col(day).isNull(), F.col(day), *(F.col(key) for key in KEYS)]


def _ranked(day: str, *carried: Column) -> Column:
    return F.struct(*(part.alias(f"by_{i}") for i, part in enumerate(_recency(day))), *carried)


def _newest_row(day: str) -> Column:
    """The greatest order of a row, which holds its day and keys: said once, they are exchanged once."""
    return F.max(_ranked(day))


def _newest_cancellation(day: str) -> Column:
    cancelled = F.col("agreement_cancellation_date")
    return F.max(F.when(cancelled.isNotNull(), _ranked(day, cancelled.alias("cancelled"))))


def _per_point(rows: DataFrame, values: Sequence[Column], outputs: Sequence[Column]) -> DataFrame:
    kept = rows.where(as_read(rows))
    return kept.groupBy(F.col("quote_mpan").alias(_POINT)).agg(*values).select(_POINT, *outputs)


def _same_point() -> Column:
    return F.col("quote_mpan").eqNullSafe(F.col(_POINT))


def latest_per_point(rows: DataFrame, day: str = "delivery_date") -> DataFrame:
    """Per supply point: newest day and keys, newest known cancellation date, any-cancelled flag."""
    return _per_point(
        rows,
        [
            _newest_row(day).alias(_NEWEST),
            F.max("agreement_cancelled_flag").alias("last_agreement_cancelled_flag"),
            _newest_cancellation(day).alias("_cancellation"),
        ],
        [
            F.col(f"{_NEWEST}.by_1").alias(_NEWEST_DAY),
            *(F.col(f"{_NEWEST}.by_{i}").alias(f"last_{key}") for i, key in enumerate(KEYS, 2)),
            F.col("last_agreement_cancelled_flag"),
            F.col("_cancellation.cancelled").alias("last_agreement_cancellation_date"),
        ],
    )


def latest_per_point_by_day(rows: DataFrame, day: str = "delivery_date") -> DataFrame:
    """``latest_per_point`` without a maximum of text, which Spark would sort for.

    The newest day of a point is a maximum of numbers, so a hash aggregate finds it. Keys and cancellations are
    then ranked among the distinct ones of the newest day's rows, of which each task hands on one a point. The
    flag is 'Y' or 'N', any other raises. Needs ``rows`` to meet the newest days in a join of its own.
    """
    flag, cancelled = F.col("agreement_cancelled_flag"), F.col("agreement_cancellation_date")
    recency = F.coalesce(F.unix_date(day), F.lit(2**31 - 1))  # a missing day is the newest
    days = rows.where(as_read(rows)).groupBy(F.col("quote_mpan").alias(_POINT)).agg(
        F.max(day).alias("_day"),
        F.max(recency).alias("_recency"),
        F.max(F.when(cancelled.isNotNull(), recency)).alias("_known"),
        F.bool_or(flag == "Y").alias("_yes"),
        F.bool_or(flag == "N").alias("_no"),
        F.bool_or(~flag.isin("Y", "N")).alias("_other"),
    )
    # No day is newer than the newest. As inequalities these stay out of the keys that rows are exchanged by, and
    # as one comparison each out of the reading of the rows, so keys, dates and the caller's join share an exchange.
    newest = recency >= F.col("_recency")
    known = F.coalesce(F.when(cancelled.isNotNull(), recency), F.lit(-(2**31))) >= F.col("_known")
    candidates = (
        rows.join(days.select(_POINT, "_recency", "_known"), _same_point() & as_read(rows, _POINT))
        .where(newest | known)
        .select(_POINT, *KEYS, cancelled.alias("_cancelled"), newest.alias("_newest"), known.alias("_is_known"))
        .distinct()
    )

    def first(chosen: Column, *order: str) -> DataFrame:
        best = Window.partitionBy(_POINT).orderBy(*(F.col(name).desc_nulls_last() for name in order))
        ranked = candidates.where(chosen).withColumn("_rank", F.row_number().over(best))
        return ranked.where(F.col("_rank") == 1)

    keys = first(F.col("_newest"), *KEYS, "_cancelled").select(
        F.col(_POINT).alias("_of"), *(F.col(key).alias(f"last_{key}") for key in KEYS)
    )
    dates = first(F.col("_is_known"), *KEYS, "_cancelled").select(
        F.col(_POINT).alias("_for"), F.col("_cancelled").alias("last_agreement_cancellation_date")
    )
    odd = F.raise_error(F.lit("agreement_cancelled_flag holds something other than Y and N"))
    letter = F.when(F.col("_other"), odd).when(F.col("_yes"), "Y").when(F.col("_no"), "N")
    point = F.col(_POINT)
    return (
        days.join(keys, point.eqNullSafe(F.col("_of")))
        .join(dates, point.eqNullSafe(F.col("_for")), "left")
        .select(
            _POINT,
            F.when(F.col("_recency") < 2**31 - 1, F.col("_day")).alias(_NEWEST_DAY),
            *(f"last_{key}" for key in KEYS),
            letter.alias("last_agreement_cancelled_flag"),
            "last_agreement_cancellation_date",
        )
    )


def attach_latest(rows: DataFrame, per_point: DataFrame, day: str = "delivery_date") -> DataFrame:
    """Rows plus the values of ``latest_per_point``.

    That no row is newer than the newest is part of the join condition. It always holds, but it keeps
    the day column among those read of ``rows``. So when ``per_point`` comes from the same aggregated
    rows, both sides read the same columns of them and Spark runs that aggregate's shuffle once.
    """
    newest_day = F.col(_NEWEST_DAY)
    not_newer = F.col(day).isNull() | newest_day.isNull() | (F.col(day) <= newest_day)
    return rows.join(per_point, _same_point() & not_newer).drop(_POINT, _NEWEST_DAY)


def latest_keys(rows: DataFrame, day: str = "delivery_date") -> DataFrame:
    """Rows plus the newest keys, the newest known cancellation date and the any-cancelled flag."""
    return attach_latest(rows, latest_per_point(rows, day), day)


def latest_cancellation(rows: DataFrame, day: str = "delivery_date") -> DataFrame:
    """Rows plus the newest cancellation date known for their supply point."""
    per_point = _per_point(
        rows,
        [_newest_cancellation(day).alias("_cancellation")],
        [F.col("_cancellation.cancelled").alias("last_agreement_cancellation_date")],
    )
    return rows.join(per_point, _same_point()).drop(_POINT)


def any_cancelled(rows: DataFrame) -> DataFrame:
    """Rows plus 'Y' if any contract of their supply point was cancelled."""
    per_point = _per_point(
        rows,
        [F.max("agreement_cancelled_flag").alias("last_agreement_cancelled_flag")],
        [F.col("last_agreement_cancelled_flag")],
    )
    return rows.join(per_point, _same_point()).drop(_POINT)
