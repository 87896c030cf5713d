"""Row numbers within groups of any size.

A window sorts a whole group in one task. Here rows are dealt by ranges of group and order instead, so a
large group lies in several ranges, one after the other. A row's number is its number within its range,
plus the rows its group has in the ranges before.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridtally.storage import free_name, stored

_EARLIER = (Window.unboundedPreceding, -1)


def spread_row_number(
    rows: DataFrame, group: Column, order: Sequence[Column], name: str, ranges: int | None = None
) -> DataFrame:
    """``rows`` plus ``name``: what ``row_number`` over ``group`` by ``order`` gives, null group included.

    Rows that ``order`` leaves equal follow each other by their other columns. Rows equal in all columns are
    counted before they are dealt, and repeated at the end, so they may be any share of all rows. ``ranges``
    is as many as the session has shuffle partitions, unless given. Runs a job: the ranges come from a
    sample, so the dealt rows are stored, and all that follows reads the same ranges, also after a lost
    executor.
    """
    columns = rows.columns
    key, place, copies, before, own_n, own_before = (
        free_name(n, rows) for n in ("_group", "_range", "_copies", "_before", "_in_range", "_ahead")
    )
    total = [*order, *(F.col(column).asc_nulls_first() for column in columns)]
    kinds = rows.groupBy(*columns).agg(F.count("*").alias(copies)).withColumn(key, group)
    dealt = kinds.repartitionByRange(ranges or _ranges(rows), F.col(key).asc_nulls_first(), *total)
    placed = stored(dealt.withColumn(place, F.spark_partition_id()))

    sizes = placed.groupBy(key, place).agg(F.sum(copies).alias(own_n))
    along = Window.partitionBy(key).orderBy(place).rowsBetween(*_EARLIER)
    # Only the first group of a range can have begun in another, so at most one row per range is left.
    begun = (
        sizes.withColumn(before, F.sum(own_n).over(along))
        .where(F.col(before).isNotNull())
        .select(F.col(key).alias(f"{key}2"), F.col(place).alias(f"{place}2"), before)
    )
    within = Window.partitionBy(place, key).orderBy(*total).rowsBetween(*_EARLIER)
    local = placed.withColumn(own_before, F.coalesce(F.sum(copies).over(within), F.lit(0)))
    same = (F.col(place) == F.col(f"{place}2")) & F.col(key).eqNullSafe(F.col(f"{key}2"))
    first = (F.col(own_before) + F.coalesce(F.col(before), F.lit(0)) + 1).cast("int")
    numbers = F.sequence(first, (first + F.col(copies) - 1).cast("int"))
    return local.join(begun, same, "left").select(*columns, F.explode(numbers).alias(name))


def _ranges(rows: DataFrame) -> int:
    conf = rows.sparkSession.conf
    first = conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None)
    return int(first or conf.get("spark.sql.shuffle.partitions"))
