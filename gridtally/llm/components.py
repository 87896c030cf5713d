"""Connected components of a graph too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridtally.llm.common import stored


def connected_components(links: DataFrame) -> DataFrame:
    """``node`` and ``component``, the smallest node it can reach, for every end of a link.

    ``links`` has two long columns, ``a`` and ``b``; direction, repeats and order do not matter, rows
    with a null end or equal ends are left out. Each round every node, and the node its label names,
    takes the smallest label next to it, then the label of its label, so the rounds grow with the
    logarithm of the longest path. Labels only fall, so an unchanged sum means none changed. Nothing
    but that sum reaches the driver, and all frames that are joined are stored first, so that the
    partitions of a hot node or label can be split.
    """
    pairs = links.where("a is not null and b is not null and a != b")
    edges = stored(
        pairs.select("a", "b").union(pairs.select(F.col("b"), F.col("a"))).distinct()
    )
    labels = stored(
        edges.groupBy(F.col("a").alias("node")).agg(
            F.least(F.col("a"), F.min("b")).alias("label")
        )
    )
    total = _total(labels)
    while True:
        beside = edges.join(labels.select(F.col("node").alias("b"), "label"), "b")
        lowest = stored(beside.groupBy(F.col("a").alias("node")).agg(F.min("label").alias("low")))
        offers = labels.join(lowest, "node")
        lowered = stored(
            offers.select("node", F.least("label", "low").alias("label"))
            .union(offers.where("low < label").select(F.col("label"), F.col("low")))
            .groupBy("node")
            .agg(F.min("label").alias("label"))
        )
        up = lowered.select(F.col("node").alias("label"), F.col("label").alias("above"))
        labels = stored(lowered.join(up, "label").select("node", F.col("above").alias("label")))
        before, total = total, _total(labels)
        if before == total:
            return labels.select("node", F.col("label").alias("component"))


def _total(labels: DataFrame) -> object:
    return labels.agg(F.sum(F.col("label").cast("decimal(38,0)"))).first()[0]
