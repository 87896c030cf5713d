"""Helpers the corpus operators share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# The contract's words: runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The Parquet table ``name`` of a data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, named by ``spark.checkpoint.dir``.

    Where the session names none, a temporary folder serves a session of this machine only.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = context.getConf().get("spark.checkpoint.dir")
        if folder is None:
            if not context.master.startswith("local"):
                raise ValueError("spark.checkpoint.dir must name a folder all executors share")
            folder = tempfile.mkdtemp(prefix="gridtally-llm-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


# What was kept in the shared folder since ``scratch`` was entered; None outside of it.
_kept: list[str] | None = None


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing else uses."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    _keep(path)
    return path


def stored(frame: DataFrame) -> DataFrame:
    """``frame``, computed once and kept by a reliable checkpoint, so that lost executors cost nothing.

    Both sides of a join of stored frames are exchanged for that join alone, so AQE may split the
    partitions of hot keys.
    """
    shared_folder(frame.sparkSession)
    kept = frame.checkpoint()
    file = kept._jdf.logicalPlan().rdd().getCheckpointFile()
    if file.isDefined():
        _keep(file.get())
    return kept


def _keep(path: str) -> None:
    if _kept is not None:
        _kept.append(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Deletes, at its end, what was kept in the shared folder within it.

    For work whose result has been written elsewhere by then. Frames made within must not be used after it.
    """
    global _kept
    outer, _kept = _kept, []
    try:
        yield
    finally:
        inner, _kept = _kept, outer
        for path in inner:
            discard(spark, path)


def discard(spark: SparkSession, path: str) -> None:
    """Delete a path in the shared folder and all below it; nothing if it is not there."""
    if not path.startswith(shared_folder(spark)):
        raise ValueError(f"{path} is not in the shared folder")
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def numbered(frame: DataFrame) -> DataFrame:
    """``frame`` written once, as ``row`` (a struct of its columns) and ``number``, different for each row.

    What is read from it names every row alike, also where a task is run again, and reads its columns only.
    """
    path = new_path(frame.sparkSession, "numbered")
    rows = frame.select(F.struct(*frame.columns).alias("row"), F.monotonically_increasing_id().alias("number"))
    rows.write.parquet(path)
    return frame.sparkSession.read.parquet(path)


def totals_before(rows: DataFrame, group: list[str], order: str, coarse: Column, value: str, name: str) -> DataFrame:
    """``rows`` with the column ``name``: the sum of ``value`` over the rows of its group that come before.

    ``coarse`` never falls along ``order``. Its stretches are summed first, then the rows within each, so
    a task holds the stretches of one group or the rows of one stretch, never all rows of a group. Null
    groups are groups like others.
    """
    earlier = (Window.unboundedPreceding, -1)
    marked = stored(rows.withColumn("_coarse", coarse))
    keys = [*group, "_coarse"]
    stretches = marked.groupBy(*keys).agg(F.sum(value).alias("_sum"))
    along = Window.partitionBy(*group).orderBy("_coarse").rowsBetween(*earlier)
    ahead = stored(stretches.select(*keys, F.coalesce(F.sum("_sum").over(along), F.lit(0)).alias("_ahead")))
    within = Window.partitionBy(*keys).orderBy(order).rowsBetween(*earlier)
    inside = marked.withColumn("_inside", F.coalesce(F.sum(value).over(within), F.lit(0)))
    same = [inside[key].eqNullSafe(ahead[key]) for key in keys]
    return inside.join(ahead, same).select(
        *(inside[column] for column in rows.columns), (F.col("_ahead") + F.col("_inside")).alias(name)
    )


def remainder(doc_id: Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; null for null."""
    return F.crc32(doc_id.cast("string")) % divisor


def bounded_sample(labels: DataFrame, docs: DataFrame, rows: int) -> DataFrame:
    """At most ``rows`` rows of ``docs`` with the column ``label`` of ``labels``, both by ``doc_id``.

    The ids with the smallest hashes are taken, so the sample does not depend on partitioning. It has
    at most ``rows`` ids, which bounds the broadcast. Only for fitting a model.
    """
    ids = labels.groupBy("doc_id").agg(F.min("label").alias("label"))
    ids = ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    return docs.join(F.broadcast(ids), "doc_id")
