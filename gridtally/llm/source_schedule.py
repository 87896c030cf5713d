"""Mix sources to target weights by a low-discrepancy schedule of equal blocks of words."""

from __future__ import annotations

from hashlib import md5

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridtally.llm.common import WORD, numbered, stored, totals_before

BLOCK_WORDS = 4_096
MAX_REPEATS = 3
# Sums of sizes within a source are built from chunks of about so many documents.
CHUNK_ROWS = 2_000
# A chunk is named by up to eight hexadecimal digits; the sums of chunks are added up by the first of them.
COARSE_DIGITS = 4
# Where all rows without id stand in a stream.
_NO_ID = md5(b"mix:").hexdigest()
# Slots are matched to sources by ranges of so many points, and ranked within chunks of so many slots.
RANGE_POINTS = 1_024
CHUNK_SLOTS = 65_536
# Above this, a product of two slot numbers would not fit a long.
_MAX_SLOTS = 1 << 31


def sized(docs: DataFrame) -> DataFrame:
    """``docs`` with the column ``size``: words of the text, 0 for null."""
    return docs.withColumn("size", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long"))


def source_targets(sizes: DataFrame, repeats: int = MAX_REPEATS) -> DataFrame:
    """``source``, ``documents``, ``source_size`` and ``target`` of each source.

    In code point order, null last, sources weigh 1, 2, 3, repeating, and share the words of all. No
    target is above ``repeats`` times its source; the rest is shared by weight among the others until
    none is. So every target is the smaller of that limit and its weight times one level: with the
    sources ordered by limit per weight, the level follows from the first that stays below. One row per
    source, so one task orders them.
    """
    totals = sizes.groupBy("source").agg(
        F.count("*").alias("documents"), F.sum("size").alias("source_size")
    )
    named = Window.orderBy(F.col("source").asc_nulls_last())
    weighed = totals.withColumn("weight", (F.row_number().over(named) - 1) % 3 + 1).withColumn(
        "most", F.col("source_size") * repeats
    )
    tightest = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    before = tightest.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (
        F.sum("source_size").over(everything) - F.coalesce(F.sum("most").over(before), F.lit(0))
    ) / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
    levels = weighed.withColumn("level", level)
    stays = F.when(F.col("level") * F.col("weight") <= F.col("most"), F.col("level"))
    final = F.max(stays).over(everything)
    return levels.withColumn(
        "target", F.least(F.col("most").cast("double"), F.col("weight") * final)
    ).select("source", "documents", "source_size", F.coalesce("target", F.lit(0.0)).alias("target"))


def streams(sizes: DataFrame, targets: DataFrame, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Documents with ``start``: the words before them in the shuffled stream of their source.

    A stream is ordered by a hash of the id. Chunks of it, by the first digits of the hash, are summed
    first, and their sums by fewer digits, so no task holds more of a source than one chunk or 65,536 sums.
    Rows without id share one place, ordered by size: their chunks are a size and up to 65,536 parts of its
    rows, by a hash of the row, and one task adds up a source's different sizes.
    """
    chunked = _chunked(sizes, targets, chunk_rows)
    sums = chunked.groupBy("source", "chunk").agg(F.sum("size").alias("words"))
    offsets = stored(totals_before(sums, ["source"], "chunk", _coarse(F.col("chunk")), "words", "offset").drop("words"))
    within = (
        Window.partitionBy("source", "chunk")
        .orderBy("place", "doc_id", "size", "spread")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = chunked.withColumn("inside", F.coalesce(F.sum("size").over(within), F.lit(0)))
    same = placed["source"].eqNullSafe(offsets["source"]) & (placed["chunk"] == offsets["chunk"])
    return (
        placed.join(offsets, same)
        .select(placed["*"], (F.col("offset") + F.col("inside")).alias("start"))
        .drop("inside", "chunk", "place", "spread")
    )


def _chunked(sizes: DataFrame, targets: DataFrame, chunk_rows: int) -> DataFrame:
    """Documents with ``place``, ``spread`` and the ``chunk`` of their source; chunks are in the stream's order.

    Rows without id stand between two parts of the chunk that their place is in, named without and with ~.
    """
    hashed = sizes.withColumns(
        {
            "place": F.md5(F.concat(F.lit("mix:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))),
            "spread": F.lpad(F.lower(F.hex(F.xxhash64(*sizes.columns))), 16, "0"),
        }
    )
    width = F.least(
        F.lit(8), F.ceil(F.log(16.0, F.greatest(F.col("documents") / chunk_rows, F.lit(1.0)))).cast("int")
    )
    chunked = hashed.join(targets, hashed["source"].eqNullSafe(targets["source"])).drop(targets["source"])
    digits = F.substring("place", F.lit(1), width)
    size = F.lpad(F.lower(F.hex("size")), 16, "0")
    part = F.substring("spread", F.lit(1), F.least(F.lit(4), width))
    behind = (F.col("place") >= _NO_ID) & F.lit(_NO_ID).startswith(digits)
    chunk = (
        F.when(F.col("doc_id").isNull(), F.concat(F.lit(_NO_ID), size, part))
        .when(behind, F.concat(digits, F.lit("~")))
        .otherwise(digits)
    )
    return stored(chunked.withColumn("chunk", chunk))


def _coarse(chunk: Column) -> Column:
    """Fewer digits of the chunk; for rows without id, their size. It never falls along the chunks."""
    near = _NO_ID[:COARSE_DIGITS]
    return (
        F.when(F.length(chunk) > len(_NO_ID), F.substring(chunk, 1, len(_NO_ID) + 16))
        .when(chunk.startswith(near) & (chunk > _NO_ID), F.lit(near + "~"))
        .otherwise(F.substring(chunk, 1, COARSE_DIGITS))
    )


def schedule(targets: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The mix in order: ``slot``, ``source``, ``rank`` within the source, its ``block`` and ``words``.

    A source needs as many slots as blocks of its stream, read in order and again from the front, until
    its target is reached; the last block is cut there. Slot i of n stands at point i * g mod n, where g
    is a whole number near n / golden ratio that shares no factor with n, so the points fill 0 to
    n - 1 evenly at any time. Points map through the cumulative slot numbers of the sources. Each
    stretch of the schedule therefore holds every source in proportion, and each source gets exactly
    its slots.
    """
    spark = targets.sparkSession
    needed = targets.withColumn("goal", F.round("target").cast("long")).where("goal > 0")
    total = needed.agg(F.sum("goal")).first()[0] or 0
    block = max(block_words, -(-total // _MAX_SLOTS))
    blocks = F.ceil(F.col("source_size") / block).cast("long")
    rounds = F.floor(F.col("goal") / F.col("source_size")).cast("long")
    left = F.col("goal") - rounds * F.col("source_size")
    slots = rounds * blocks + F.ceil(left / block).cast("long")
    upto = Window.orderBy(F.col("source").asc_nulls_last())
    counted = needed.select(
        "source", "source_size", "goal", blocks.alias("blocks"), slots.alias("slots")
    ).withColumn("last", F.sum("slots").over(upto))
    counted = stored(counted.withColumn("first", F.col("last") - F.col("slots")))
    n = counted.agg(F.max("last")).first()[0] or 0
    ranges = counted.withColumn(
        "range",
        F.explode(
            F.sequence(
                F.floor(F.col("first") / RANGE_POINTS), F.floor((F.col("last") - 1) / RANGE_POINTS)
            )
        ),
    )
    points = (
        spark.range(n)
        .select(F.col("id").alias("slot"), (F.col("id") * _step(n) % max(n, 1)).alias("point"))
        .withColumn("range", F.floor(F.col("point") / RANGE_POINTS))
    )
    mapped = points.join(ranges, "range").where("point >= first and point < last")
    chunk = F.floor(F.col("slot") / CHUNK_SLOTS)
    mapped = stored(mapped.select("slot", "source", "source_size", "goal", "blocks", chunk.alias("chunk")))
    earlier = Window.partitionBy("source").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = stored(
        mapped.groupBy("source", "chunk")
        .agg(F.count("*").alias("slots"))
        .select("source", "chunk", F.coalesce(F.sum("slots").over(earlier), F.lit(0)).alias("offset"))
    )
    ranked = mapped.withColumn(
        "inside", F.row_number().over(Window.partitionBy("source", "chunk").orderBy("slot")) - 1
    )
    same = ranked["source"].eqNullSafe(offsets["source"]) & (ranked["chunk"] == offsets["chunk"])
    rank = F.col("offset") + F.col("inside")
    whole = F.least(F.lit(block), F.col("source_size") - F.col("block") * block)
    reached = F.floor(F.col("rank") / F.col("blocks")) * F.col("source_size") + F.col("block") * block
    return (
        ranked.join(offsets, same)
        .select("slot", ranked["source"], "source_size", "goal", "blocks", rank.cast("long").alias("rank"))
        .withColumn("block", F.col("rank") % F.col("blocks"))
        .select(
            "slot", "source", "rank", "block", F.lit(block).cast("long").alias("block_words"),
            F.least(whole, F.col("goal") - reached).cast("long").alias("words"),
        )
    )


def _step(n: int) -> int:
    """The step near n / golden ratio, without a common factor, whose multiples modulo n are most even.

    They are the more even the smaller the quotients of the two numbers' division chain are.
    """
    from math import gcd

    def largest_quotient(step: int) -> int:
        a, b, largest = n, step, 0
        while b:
            largest, a, b = max(largest, a // b), b, a % b
        return largest

    ideal = n * (5**0.5 - 1) / 2
    near = range(max(1, round(ideal) - 50), max(2, min(n, round(ideal) + 51)))
    steps = [step for step in near if gcd(step, n) == 1] or [1]
    return min(steps, key=lambda step: (largest_quotient(step), abs(step - ideal)))


def mix(docs: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``doc_id``, ``source``, ``size``, ``source_size``, ``target`` and ``taken`` for each row of ``docs``.

    ``taken`` is how many of the document's words the schedule reads, repeats counted: the words it
    shares with each block, as often as that block has a slot. A source's taken words are its target,
    rounded; no document is read more than ``MAX_REPEATS`` times. Documents without words are in no
    block: 0 taken. Rows that repeat an id are documents of their own; among equal ones it makes no
    difference which comes first. The order is a hash of ids, so reruns agree.
    """
    rows = docs.select("doc_id", "source", "text", F.monotonically_increasing_id().alias("row"))
    return _mix(rows, block_words).drop("row")


def _mix(docs: DataFrame, block_words: int) -> DataFrame:
    """``mix`` of documents with the column ``row``, a number of their own, which it returns too."""
    sizes = stored(sized(docs).select("doc_id", "source", "size", "row"))
    targets = stored(source_targets(sizes))
    placed = stored(streams(sizes, targets))
    used = schedule(targets, block_words)
    reads = stored(
        used.groupBy("source", "block", "block_words", "words").agg(F.count("*").alias("times"))
    )
    step = reads.agg(F.max("block_words")).first()[0] or block_words
    pieces = placed.where("size > 0").select(
        "row", "source", "size", "start",
        F.explode(
            F.sequence(F.floor(F.col("start") / step), F.floor((F.col("start") + F.col("size") - 1) / step))
        ).alias("block"),
    )
    same = pieces["source"].eqNullSafe(reads["source"]) & (pieces["block"] == reads["block"])
    begin = reads["block"] * step
    shared = F.greatest(
        F.lit(0),
        F.least(F.col("start") + F.col("size"), begin + F.col("words")) - F.greatest(F.col("start"), begin),
    )
    taken = (
        pieces.join(reads, same)
        .groupBy("row")
        .agg(F.sum(shared * F.col("times")).alias("taken"))
    )
    return placed.join(taken, "row", "left").select(
        "doc_id", "source", "size", "source_size", "target",
        F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), "row",
    )


def mixed(docs: DataFrame) -> DataFrame:
    """``docs`` as the mix reads them: a row for each time, to the nearest whole number.

    Documents the mix does not reach go; documents without words weigh nothing and stay once. Rows are
    numbered, so rows that repeat an id, or have none, are read as often each as the mix says.
    """
    rows = numbered(docs)
    read = _mix(rows.select("row.doc_id", "row.source", "row.text", F.col("number").alias("row")), BLOCK_WORDS)
    times = F.when(F.col("size") == 0, 1).otherwise(F.floor(F.col("taken") / F.col("size") + 0.5)).cast("int")
    counts = stored(read.select(F.col("row").alias("number"), times.alias("times")).where("times > 0"))
    return rows.join(counts, "number").select("row", F.explode(F.sequence(F.lit(1), "times"))).select("row.*")
