"""Session settings the plans rely on. Only runtime SQL settings: nothing here needs a restart."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Results depend on these two.
SEMANTICS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}

# Speed and skew depend on these. Aggregates always shuffle on all their keys, after a partial pass,
# instead of inheriting the partitioning of the join before them: that one may follow a single hot key
# (a supply point, a contract) and would put its whole group in one task. With no aggregate relying on
# a join's partitioning, AQE is also free to split the hot partitions of every join.
SCALE = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "96MB",
    # A partition of twice the median is split, in parts of about the median, if it is over 96 MB.
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2.0",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # A side that comes out smaller than this when run is broadcast; AQE measures it.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.requireAllClusterKeysForDistribution": "true",
    # Hash instead of sorting both sides of a shuffled join when every partition of one side was
    # measured to fit; a fact then joins its small sides without being sorted each time.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    "spark.sql.exchange.reuse": "true",
}

# About this much of a shuffle goes to one partition at first; AQE joins small ones afterwards.
TARGET_PARTITION_BYTES = 256 * 1024 * 1024
# Rows in a shuffle take several times the space of the compressed columns they were read from.
_EXPANSION = 4
_INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


# Where facts are stored by their join keys (``sources.layout``), aggregates on more than those keys must
# be allowed to rely on them, or each would exchange its fact again.
LAID_OUT = {"spark.sql.requireAllClusterKeysForDistribution": "false"}

# Where a plan deals its daily rows by contract and month (``by_month``), joins and aggregates on more than those
# keys must be allowed to rely on them, or each would exchange the rows again.
BY_MONTH = {
    "spark.sql.requireAllClusterKeysForDistribution": "false",
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
}
_RELIANCE = {name: "true" for name in BY_MONTH}


def configure(
    spark: SparkSession,
    *frames: DataFrame,
    shuffle_bytes: int | None = None,
    laid_out: bool = False,
    by_month: bool = False,
) -> SparkSession:
    """Apply the settings to ``spark``, and size its shuffles.

    ``by_month`` is for plans and operators called with it; ask for it when they run, not only when they are built.

    ``laid_out`` is for tables written by ``sources.layout``, whose buckets the plans then rely on.

    ``shuffle_bytes`` is the expected size of the largest shuffle. Where it is not given it is taken
    from the size of the files that ``frames`` read; the loaders do the same for the tables they load.
    """
    wanted = {**SEMANTICS, **_RELIANCE, **SCALE, **(LAID_OUT if laid_out else {}), **(BY_MONTH if by_month else {})}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    if shuffle_bytes is None:
        shuffle_bytes = _EXPANSION * max((read_bytes(frame) for frame in frames), default=0)
    raise_partitions(spark, shuffle_bytes)
    return spark


def raise_partitions(spark: SparkSession, shuffle_bytes: int) -> None:
    """Let AQE start from enough partitions for ``shuffle_bytes``; never from fewer than it does."""
    wanted = -(-shuffle_bytes // TARGET_PARTITION_BYTES)
    current = spark.conf.get(_INITIAL, None) or spark.conf.get("spark.sql.shuffle.partitions")
    if wanted > int(current):
        spark.conf.set(_INITIAL, str(wanted))


def size_shuffles(*frames: DataFrame) -> None:
    """Raise the shuffle partitions of the frames' session to fit the largest of them."""
    for frame in frames:
        raise_partitions(frame.sparkSession, _EXPANSION * read_bytes(frame))


def read_bytes(frame: DataFrame) -> int:
    """The size of all that ``frame`` reads, by Spark's statistics. Runs no job.

    Zero where the session does not tell, as over Spark Connect: then state ``shuffle_bytes``.
    """
    plan = getattr(frame, "_jdf", None)
    if plan is None:
        return 0
    leaves = plan.queryExecution().analyzed().collectLeaves()
    sizes = (int(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.size()))
    # A source without statistics reports the largest possible size, which says nothing.
    return sum(size for size in sizes if size < 1 << 62)
