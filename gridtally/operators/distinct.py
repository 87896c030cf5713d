"""Distinct rows where copies are rare: only rows that may be copies are exchanged whole."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridtally.operators.key_filter import key_filter, mark_filter
from gridtally.operators.shared import as_dealt, as_read
from gridtally.operators.small_sides import stored_if_small
from gridtally.storage import free_name


def row_hashes(rows: DataFrame) -> list[Column]:
    """128 bits of hash over all columns. Equal rows have equal hashes; the reverse is not relied on."""
    columns = [F.col(column) for column in rows.columns]
    nulls = F.concat(*(F.when(column.isNull(), "1").otherwise("0") for column in columns))
    return [F.xxhash64(*columns), F.xxhash64(nulls, *columns)]


def distinct_by_hash(
    rows: DataFrame, hashes: Sequence[Column] | None = None, deal: Sequence[str] = ()
) -> DataFrame:
    """``rows.distinct()``, in two steps.

    The hashes alone are counted first, in a job of its own. Rows whose hash occurs once are distinct as they
    are and stay where they were read. The others are exchanged and compared in full, so rows that merely
    share a hash are both kept. The list of repeated hashes is stored and broadcast if it was measured small;
    if copies are so many that it is not, this is a plain distinct.

    With ``deal`` the result is dealt by these columns, and all rows are exchanged once, for that. Hashes are counted
    when the result runs, so what the rows are made of is exchanged once for both, and the repeated ones become a bitmap
    of fixed size, however many copies there are. The rows it lets pass are compared where they were dealt to, for which
    the session must let aggregates rely on that (``session.configure(spark, by_month=True)``), and Spark the union on
    that of its parts, as it does from 4.1 on. One hash will do then: others that set the same bit are compared as well.
    """
    hashes = row_hashes(rows) if hashes is None else hashes
    hashes = hashes[:1] if deal else hashes
    names = [free_name(f"_hash{i}", rows) for i in range(len(hashes))]
    hashed = rows.select("*", *(F.coalesce(value, F.lit(0)).alias(name) for name, value in zip(names, hashes)))
    counted = hashed.groupBy(*names).agg(F.count("*").alias("_rows"))
    repeated = counted.where(F.col("_rows") > 1).drop("_rows")
    if deal:
        mark = free_name("_copied", hashed)
        marked = mark_filter(hashed, key_filter(repeated, names), names, mark)
        dealt = marked.select(*rows.columns, mark).repartition(*deal)
        single = dealt.where(as_dealt(~F.col(mark) & as_read(dealt))).drop(mark)
        return single.unionByName(dealt.where(as_dealt(F.col(mark))).drop(mark).distinct())
    repeated = stored_if_small(repeated)
    if repeated is None:
        return rows.distinct()
    single = hashed.join(repeated, names, "left_anti").select(*rows.columns)
    copied = hashed.join(repeated, names, "left_semi").select(*rows.columns)
    return single.unionByName(copied.distinct())
