"""Join sides that are usually small but may not be, prepared ahead of a plan.

Plans are lazy: AQE broadcasts a side that comes out small, but only after the exchange of the other side
has begun. A caller that runs a plan often, or over very large facts, can compute such a side first and
pass it in: its size is known then, and a small one spares the facts their exchange altogether.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridtally.storage import stored as store

MAX_BROADCAST_BYTES = 64 * 1024 * 1024
_ROW_OVERHEAD = 48  # a hash table's bytes per row besides its values


def prepare_side(side: DataFrame) -> DataFrame:
    """Run ``side``, store it and mark it for broadcast if it takes at most ``MAX_BROADCAST_BYTES``.

    A larger side is returned as it was stored, without the mark, so that what it is made of is not read and exchanged
    once more for each use. The stored rows stay in the session's checkpoint folder until that is
    deleted, or until Spark's cleaner drops them where
    ``spark.cleaner.referenceTracking.cleanCheckpoints`` is set. The folder must be one that all
    executors share: without one, or with a folder of this machine on a cluster, this raises.
    """
    kept = store(side)
    return F.broadcast(kept) if _is_small(kept) else kept


def stored_if_small(side: DataFrame) -> DataFrame | None:
    """``side``, run, stored and marked for broadcast; nothing if it takes more than ``MAX_BROADCAST_BYTES``."""
    kept = store(side)
    return F.broadcast(kept) if _is_small(kept) else None


def _is_small(kept: DataFrame) -> bool:
    widest = [F.max(F.octet_length(F.col(name).cast("string"))) for name in kept.columns]
    rows, *widths = kept.agg(F.count("*"), *widest).first()
    size = rows * (_ROW_OVERHEAD + sum(width or 0 for width in widths))
    return size <= MAX_BROADCAST_BYTES
