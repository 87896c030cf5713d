"""Shards as runs of a Hilbert curve through the documents' metadata."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridtally.llm.common import numbered, stored, totals_before

SHARDS = 16
# Four dimensions of so many bits each: at most 65,536 cells.
BITS = 4
# Cells are cut into pieces of about so many rows.
PIECE_ROWS = 10_000
# Rows that repeat an id and a text share a piece. With more than so many rows in one, rows are numbered first.
FULL_PIECE = 8 * PIECE_ROWS
# Shards are written in files of about so many rows.
FILE_ROWS = 50_000
# The counts of a cell's pieces are added up in stretches of so many.
COARSE_PIECES = 16_384


def size_of(text: Column) -> Column:
    """UTF-8 bytes plus one; one for null."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def checksum(text: Column) -> Column:
    """CRC-32 of the UTF-8 bytes; that of no bytes for null."""
    return F.coalesce(F.crc32(text), F.lit(0)).cast("long")


def hilbert_index(dimensions: list[Column], bits: int = BITS) -> Column:
    """The place on the Hilbert curve of a cell, given by whole numbers below 2 ** bits.

    Two passes over the bits, from the highest: the first undoes the turns of the sub-cubes, swapping
    or inverting the lower bits of the first coordinate; the second is a Gray code. Then the bits are
    read across the coordinates. A struct per step keeps the expressions small.
    """
    n = len(dimensions)
    point = F.array(*(d.cast("long") for d in dimensions))
    steps = [(1 << bit, i) for bit in range(bits - 1, 0, -1) for i in range(n)]
    turns = F.array(*(F.struct(F.lit(q).cast("long").alias("q"), F.lit(i).alias("i")) for q, i in steps))

    def turn(x: Column, step: Column) -> Column:
        q, i = step["q"], step["i"]
        own, first = F.get(x, i), F.get(x, F.lit(0))
        low = q - F.lit(1)
        swapped = first.bitwiseXOR(own).bitwiseAND(low)
        inverted = own.bitwiseAND(q) != 0
        return F.transform(
            x,
            lambda value, at: F.when(inverted, F.when(at == 0, value.bitwiseXOR(low)).otherwise(value)).otherwise(
                F.when((at == 0) | (at == i), value.bitwiseXOR(swapped)).otherwise(value)
            ),
        )

    turned = F.aggregate(turns, point, turn)
    gray = F.aggregate(
        turned,
        F.array().cast("array<long>"),
        lambda done, value: F.concat(
            done, F.array(value.bitwiseXOR(F.coalesce(F.get(done, F.size(done) - 1), F.lit(0).cast("long"))))
        ),
    )
    flips = F.aggregate(
        F.array(*(F.lit(1 << bit).cast("long") for bit in range(bits - 1, 0, -1))),
        F.lit(0).cast("long"),
        lambda total, q: F.when(
            F.get(gray, F.lit(n - 1)).bitwiseAND(q) != 0, total.bitwiseXOR(q - F.lit(1))
        ).otherwise(total),
    )
    places = F.array(
        *(
            F.struct(F.lit(i).alias("i"), F.lit(1 << bit).cast("long").alias("q"))
            for bit in range(bits - 1, -1, -1)
            for i in range(n)
        )
    )
    both = F.struct(gray.alias("g"), flips.alias("t"))
    return F.aggregate(
        F.array(both),
        F.lit(0).cast("long"),
        lambda _, b: F.aggregate(
            places,
            F.lit(0).cast("long"),
            lambda index, p: index * 2
            + F.when(F.get(b["g"], p["i"]).bitwiseXOR(b["t"]).bitwiseAND(p["q"]) != 0, 1).otherwise(0),
        ),
    )


def _shared_bytes(low: str | None, high: str | None) -> int:
    """How many bytes two strings begin with alike; all strings between them do too."""
    one, other = (low or "").encode(), (high or "").encode()
    return next((i for i, (a, b) in enumerate(zip(one, other)) if a != b), min(len(one), len(other)))


def _code(value: Column, skipped: int) -> Column:
    """A number below 2 ** 16 from the two bytes after ``skipped`` ones, in the order of strings; -1 for null."""
    two = F.hex(F.substring(F.encode(value, "UTF-8"), skipped + 1, 2))
    return F.coalesce(F.conv(F.rpad(two, 4, "0"), 16, 10).cast("int"), F.lit(-1))


def _begins(counts: dict[int, int], side: int) -> list[int]:
    """The codes at which each coordinate after the first begins, so that they hold about equally many rows."""
    total, before, begins = sum(counts.values()), 0, []
    for code, rows in sorted(counts.items()):
        place = min(side - 1, int(side * (before + rows / 2) / total))
        begins += [code] * (place - len(begins))
        before += rows
    return begins


def _passed(begins: list[int]) -> Callable[[Column], Column]:
    return lambda code: sum(((code >= begin).cast("long") for begin in begins), F.lit(0).cast("long"))


def _text_axes(docs: DataFrame, names: tuple[str, str], ends: list[tuple], side: int) -> list[Column]:
    """For each column a coordinate below ``side`` that rises with the text, by code point, nulls first.

    ``ends`` are the smallest and greatest value of each. What all values begin with is skipped, and the next
    two bytes are counted: at most 65,537 numbers a column reach the driver, however many values there are.
    """
    codes = [_code(F.col(name).cast("string"), _shared_bytes(*end)) for name, end in zip(names, ends)]
    told = F.explode(F.array(*(F.struct(F.lit(i).alias("axis"), code.alias("code")) for i, code in enumerate(codes))))
    counts = docs.select(told.alias("x")).groupBy("x.axis", "x.code").count().collect()
    axes = []
    for i, code in enumerate(codes):
        begins = _begins({r["code"]: r["count"] for r in counts if r["axis"] == i}, side) if counts else []
        # Within the lambda the code is a variable, so that it is computed once and not for each comparison.
        axes.append(F.get(F.transform(F.array(code), _passed(begins)), F.lit(0)))
    return axes


def sharded(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``docs`` with ``size``, ``text_crc32``, ``curve``, ``shard`` and ``slot``.

    The dimensions are source and language by code point, each cut where about equally many rows lie, the
    text's bytes by powers of two, and the id among all ids. So a shard, and a stretch of its slots, spans few
    sources, languages, sizes and ids, and a reader can skip files by the smallest and greatest values in them.
    Rows are ordered along the curve, within a cell by a hash, and cut into runs whose row counts differ
    by one at most; ``slot`` counts from 0 in each. Rows with equal texts are not kept together.

    Positions are built from counts: of cells (at most 65,536), of stretches of ``COARSE_PIECES`` pieces of
    a cell, of the pieces, and of rows within a piece of about ``PIECE_ROWS``, so no task holds more,
    however many rows a cell has. Rows that repeat an id and a text share a piece; if that makes one of over
    ``FULL_PIECE`` rows, all rows are first stored with a number, which tells them apart. Null sources,
    languages, texts and ids have values of their own. Equal rows may take each other's place. Columns of these
    names in ``docs`` are replaced.
    """
    new = ("size", "text_crc32", "curve", "shard", "slot")
    own = [name for name in docs.columns if name not in new]
    names = ("source", "lang")
    edges = [f(F.col(name).cast("string")) for name in names for f in (F.min, F.max)]
    total, low, high, *ends = docs.agg(F.count("*"), F.min("doc_id"), F.max("doc_id"), *edges).first()
    low, high, side = low or 0, high or 0, 1 << BITS
    pieces = -(-max(total, 1) // PIECE_ROWS)
    share = (F.col("doc_id").cast("double") - float(low)) / (float(high) - float(low) + 1)
    cell = [
        *_text_axes(docs, names, [(ends[0], ends[1]), (ends[2], ends[3])], side),
        F.least(F.lit(side - 1), F.greatest(F.lit(0), F.floor(F.log2(F.col("size"))) - 3)),
        F.coalesce(F.least(F.lit(side - 1), F.floor(share * side)), F.lit(0)),
    ]
    placed = _placed(docs, own, cell, pieces)
    counts = stored(placed.groupBy("curve", "_piece").agg(F.count("*").alias("rows")))
    if (counts.agg(F.max("rows")).first()[0] or 0) > FULL_PIECE:
        known = numbered(docs.select(*own))
        rows = known.select(*(F.col("row")[name].alias(name) for name in own), F.col("number").alias("_tie"))
        placed = _placed(rows, own, cell, pieces, "_tie")
        counts = stored(placed.groupBy("curve", "_piece").agg(F.count("*").alias("rows")))
    along = Window.orderBy("curve").rowsBetween(Window.unboundedPreceding, -1)
    cells = counts.groupBy("curve").agg(F.sum("rows").alias("rows"))
    cells = stored(cells.select("curve", F.coalesce(F.sum("rows").over(along), F.lit(0)).alias("before")))
    stretch = F.floor(F.col("_piece") / COARSE_PIECES)
    offsets = stored(
        totals_before(counts, ["curve"], "_piece", stretch, "rows", "within")
        .join(cells, "curve")
        .select("curve", "_piece", (F.col("before") + F.col("within")).alias("_offset"))
    )
    rank = F.row_number().over(
        Window.partitionBy("curve", "_piece").orderBy("_order", "doc_id", "text_crc32", "size")
    )
    position = F.col("_offset") + F.col("_rank") - 1
    return (
        placed.withColumn("_rank", rank)
        .join(offsets, ["curve", "_piece"])
        .withColumn("_position", position.cast("long"))
        .withColumn("shard", F.expr(f"cast(_position * {shards} div {max(total, 1)} as int)"))
        .withColumn("slot", F.expr(f"_position - (cast(shard as long) * {total} + {shards - 1}) div {shards}"))
        .select(*(F.col(f"_own{i}").alias(name) for i, name in enumerate(own)), *new)
    )


def _placed(docs: DataFrame, own: list[str], cell: list[Column], pieces: int, *ties: str) -> DataFrame:
    """Rows with their cell and piece; the caller's columns under names that clash with none."""
    order = F.xxhash64("doc_id", "text_crc32", *ties)
    piece = F.floor(F.shiftrightunsigned(order, 33).cast("double") / float(1 << 31) * pieces)
    return (
        docs.select(
            *(F.col(name).alias(f"_own{i}") for i, name in enumerate(own)), "doc_id", "source", "lang", *ties,
            size_of(F.col("text")).alias("size"), checksum(F.col("text")).alias("text_crc32"),
        )
        .withColumn("curve", hilbert_index(cell))
        .withColumns({"_order": order, "_piece": piece})
    )


def in_files(found: DataFrame, total: int, shards: int = SHARDS, rows: int = FILE_ROWS) -> DataFrame:
    """The ``sharded`` rows of ``total`` documents, dealt so that each file written holds about ``rows``
    slots of one shard, in order. How many files a shard fills follows from ``total`` alone.
    """
    sizes = [-(-(shard + 1) * total // shards) + (-shard * total // shards) for shard in range(shards)]
    first = [0]
    for size in sizes:
        first.append(first[-1] + -(-size // rows))
    file = F.element_at(F.array(*map(F.lit, first)), F.col("shard") + 1) + F.floor(F.col("slot") / rows)
    return found.repartitionById(max(first[-1], 1), file.cast("int")).sortWithinPartitions("shard", "slot")
