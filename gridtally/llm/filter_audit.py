"""How filters of documents interact: what each removes in every order in which they could be applied.

The orders of the filters are numbered lexicographically. A document that fails a set of filters is
removed at step k of an order if the order's first k - 1 filters are outside the set and the k-th is in it.
The orders that begin with the same k filters are neighbours in that numbering, so a set's removals at a
step cover a few intervals of ranks. Documents are counted per set, the counts are added at the beginning
of each interval and taken off at its end, and a running sum along the ranks gives the removals of all
orders at once.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridtally.llm.common import WORD, stored

FILTERS = "ABCDE"
MIN_WORDS = 200
MIN_DISTINCT_PERCENT = 50
MAX_CAPITAL_PERCENT = 3
SYMBOLS = "[#$%&*|]"

_COUNTS = ("removed", "good_lost", "toxic_lost")


def failed_by_text(text: Column) -> dict[str, Column]:
    """Whether a text fails each filter that looks at nothing else; a null text is an empty one."""
    whole = F.coalesce(text, F.lit(""))
    words = F.regexp_extract_all(whole, F.lit(WORD), F.lit(0))
    capitals = F.regexp_count(whole, F.lit("[A-Z]"))
    return {
        "A": F.size(words) < MIN_WORDS,
        "B": 100 * F.size(F.array_distinct(words)) < MIN_DISTINCT_PERCENT * F.size(words),
        "C": 100 * capitals > MAX_CAPITAL_PERCENT * F.length(whole),
        "D": whole.rlike(SYMBOLS),
    }


def failures(docs: DataFrame, part: str = "lang") -> DataFrame:
    """Per row of ``docs`` its ``doc_id``, ``part`` and ``mask``, whose bit i is set if it fails filter i.

    Filter E fails a row whose text, by SHA-256, a row with a smaller id has too, whether that is removed
    or not. Rows without id have no smaller id and are none; rows that repeat the smallest id pass. Null
    texts equal empty ones, a null part is the empty one. Digests and ids are shuffled, never texts; they
    meet on both together, so a text that many rows share is in no single task.
    """
    rows = docs.select("doc_id", "text", F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"))
    digest = F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256)).alias("digest")
    first = rows.select("doc_id", digest).groupBy("digest").agg(F.min("doc_id").alias("doc_id"))
    first = first.withColumn("first", F.lit(True))
    bits = [F.when(fails, 1 << FILTERS.index(name)).otherwise(0) for name, fails in failed_by_text(F.col("text")).items()]
    own = rows.select("doc_id", "part", sum(bits[1:], bits[0]).alias("mask"), digest)
    copied = F.col("doc_id").isNotNull() & F.col("first").isNull()
    copy_bit = F.when(copied, 1 << FILTERS.index("E")).otherwise(0)
    return own.join(first, ["digest", "doc_id"], "left").select(
        "doc_id", "part", F.col("mask").bitwiseOR(copy_bit).alias("mask")
    )


def mask_counts(failed: DataFrame, labels: DataFrame) -> DataFrame:
    """Per ``part`` and ``mask`` the rows of ``failed``, and how many of them are labelled good and toxic.

    A row is good or toxic if any row of ``labels`` with its id says so. Stored once.
    """
    said = labels.groupBy("doc_id").agg(
        F.max((F.col("quality") == 1).cast("long")).alias("good"), F.max((F.col("toxic") == 1).cast("long")).alias("toxic")
    )
    total = lambda name: F.sum(F.coalesce(F.col(name), F.lit(0)))
    return stored(
        failed.join(said, "doc_id", "left")
        .groupBy("part", "mask")
        .agg(F.count("*").alias("removed"), total("good").alias("good_lost"), total("toxic").alias("toxic_lost"))
    )


def orders(filters: str = FILTERS) -> list[str]:
    """All orders, each at its lexicographic rank."""
    return ["".join(order) for order in permutations(sorted(filters))]


def removal_intervals(filters: str = FILTERS) -> list[tuple[int, int, int, int]]:
    """``(mask, step, low, high)``: rows that fail ``mask`` go at ``step`` in the orders of ranks low to high.

    ``high`` is excluded. The Lehmer code of an order counts, for each place, the unused filters before the
    one that stands there; a digit c at place k moves the rank by c * (n - k)!, so a prefix fixes an interval.
    """
    names = sorted(filters)
    found: list[tuple[int, int, int, int]] = []

    def extend(mask: int, step: int, low: int, unused: list[str]) -> None:
        width = factorial(len(unused) - 1)
        for digit, name in enumerate(unused):
            start = low + digit * width
            if mask >> filters.index(name) & 1:
                found.append((mask, step, start, start + width))
            else:
                extend(mask, step + 1, start, [other for other in unused if other != name])

    for mask in range(1, 1 << len(names)):
        extend(mask, 1, 0, names)
    return found


def interaction_audit(spark: SparkSession, counts: DataFrame, filters: str = FILTERS) -> DataFrame:
    """One row per part, order of the filters and step, from the ``mask_counts``; zeros included.

    Only the table of intervals, which the number of filters fixes, is broadcast. All sorting is of the
    ranks of one part and step or the steps of one part and order. No rows give no result.
    """
    ranks, steps = factorial(len(filters)), len(filters)
    intervals = spark.createDataFrame(removal_intervals(filters), "mask int, step int, low int, high int")
    zero = [F.lit(0).cast("long").alias(name) for name in _COUNTS]
    plus = F.struct(F.col("low").alias("rank"), *_COUNTS)
    minus = F.struct(F.col("high").alias("rank"), *((-F.col(name)).alias(name) for name in _COUNTS))
    ends = counts.join(F.broadcast(intervals), "mask").select("part", "step", F.explode(F.array(plus, minus)).alias("end"))
    bits = {name: 1 << filters.index(name) for name in filters}
    rows_of = lambda test: F.sum(F.when(test, F.col("removed")).otherwise(0))
    parts = counts.groupBy("part").agg(
        F.sum("removed").alias("total"),
        F.create_map(*(x for name, bit in bits.items() for x in (F.lit(name), rows_of(F.col("mask").bitwiseAND(bit) > 0)))).alias("failing"),
        F.create_map(*(x for name, bit in bits.items() for x in (F.lit(name), rows_of(F.col("mask") == bit)))).alias("alone"),
    )
    each_step = parts.select("part", F.explode(F.sequence(F.lit(1), F.lit(steps))).alias("step"))
    each = each_step.select("part", "step", F.explode(F.sequence(F.lit(0), F.lit(ranks - 1))).alias("rank"), *zero)
    changes = (
        ends.select("part", "step", "end.*")
        .where(F.col("rank") < ranks)
        .unionByName(each)
        .groupBy("part", "step", "rank")
        .agg(*(F.sum(name).alias(name) for name in _COUNTS))
    )
    along = Window.partitionBy("part", "step").orderBy("rank").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = changes.select("part", "step", "rank", *(F.sum(name).over(along).alias(name) for name in _COUNTS))
    down = Window.partitionBy("part", "rank").orderBy("step").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    order = F.element_at(F.array(*map(F.lit, orders(filters))), F.col("rank") + 1)
    named = summed.select(
        "*", F.sum("removed").over(down).alias("gone"), order.alias("filter_order"),
        order.substr(F.col("step"), F.lit(1)).alias("filter"),
    )
    share = F.sum("removed").over(Window.partitionBy("part", "filter"))
    return named.select("*", share.alias("shapley")).join(parts, "part").select(
        "part", "filter_order", "step", "filter",
        (F.col("total") - F.col("gone")).alias("kept"), "removed",
        (F.col("failing")[F.col("filter")] - F.col("removed")).alias("redundant"),
        F.col("alone")[F.col("filter")].alias("unique_fails"), "good_lost", "toxic_lost", "shapley",
    )
