"""From raw documents to the shards of a training mix, with the operators of ``gridtally.llm``.

The stages take the columns of documents and return them, the last with its shards. Documents that score
below the threshold go, one document of each near-duplicate group stays, contaminated documents go, the
mix repeats or leaves out documents to meet its sources' targets, and what it reads is sharded.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gridtally.llm import decontamination_wm, hilbert_shards, quality_gam, simhash_ball, source_schedule
from gridtally.llm.common import discard, new_path, scratch, table
from gridtally.llm.queries import quality_labels


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the quality classifier keeps. It learns from the labels of these documents."""
    model = quality_gam.fit_on(docs, quality_labels(table(spark, sf_dir, "labels")))
    return quality_gam.keep_good(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash near-duplicates, the one with the smallest id."""
    return simhash_ball.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark."""
    return decontamination_wm.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources reads them."""
    return source_schedule.mixed(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their size, checksum, curve index, shard and slot, in files by shard and slot."""
    return hilbert_shards.in_files(hilbert_shards.sharded(docs), docs.count())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("sharding", sharding),
]

# No SQL states the quality model or the fingerprints; tests/llm checks every stage by brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage. Each stage is written to the shared folder and read by the next.

    When a stage is written, what it kept in between and what it read are deleted, so no more than two copies
    of the documents are there at a time; the last one stays.
    """
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = new_path(spark, name)
        with scratch(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        if before is not None:
            discard(spark, before)
        docs, before = spark.read.parquet(path), path
    return docs
