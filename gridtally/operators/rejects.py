"""Rows whose date keys cannot be read, set aside with a reason instead of ending the job.

The operators parse date keys strictly: one bad key among billions raises. Where that is not wanted, their
``_lenient`` forms check the keys first. The checked rows are written once, in one folder for the good and one
for the bad, so that both results come from the same scan and reading one does not touch the other.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridtally.functions.dates import is_bad_date_key
from gridtally.storage import free_name, new_path

REASON = "reason"


@dataclass(frozen=True)
class Checked:
    """Each row checked is in one of the two; ``rejected`` has the column ``reason`` besides its own."""

    accepted: DataFrame
    rejected: DataFrame


def check_date_keys(rows: DataFrame, keys: Sequence[str], needed: Column | None = None) -> Checked:
    """``rows`` whose ``keys`` are dates or null, and the others with a reason that names the bad keys.

    Where ``needed`` is not true a bad key does not matter. Runs a job, which stores ``rows`` in the shared
    folder; they stay there until it is deleted.
    """
    if REASON in rows.columns:
        raise ValueError(f"rows have a column {REASON} already")
    matters = F.lit(True) if needed is None else F.coalesce(needed, F.lit(False))
    bad = [
        F.when(matters & is_bad_date_key(F.col(key)), F.concat(F.lit(f"{key} is not yyyyMMdd: "), F.col(key).cast("string")))
        for key in keys
    ]
    flag = free_name("_rejected", rows)
    marked = rows.withColumn(REASON, F.concat_ws("; ", *bad)).withColumn(flag, F.col(REASON) != "")
    path = new_path(rows.sparkSession, "checked")
    marked.write.partitionBy(flag).parquet(path)
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in marked.schema.fields])
    back = rows.sparkSession.read.schema(schema).parquet(path)
    accepted, rejected = back.where(~F.col(flag)), back.where(F.col(flag))
    return Checked(accepted.drop(flag, REASON), rejected.drop(flag))
