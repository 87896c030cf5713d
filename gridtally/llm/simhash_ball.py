"""Near-duplicates by SimHash: meet-in-the-middle ball hashing."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from gridtally.llm.common import numbered, stored
from gridtally.llm.components import connected_components

SHINGLE_WORDS = 3
MAX_BITS = 3
SEED = 42
# A key with more fingerprints than this is split by a second ball hashing of the erased bits.
GROUP_LIMIT = 50_000

_BITS = 64


def fingerprint_of(text: str | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """The fingerprint of one text, as an unsigned integer; zero if it has no words."""
    words = text.encode().lower().split() if text else []
    if not words:
        return 0
    width = min(shingle_words, len(words))
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: len(words) - width + 1].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array(
        [digest(joined[i:j], SEED) for i, j in zip(starts, ends[width - 1 :].tolist())],
        dtype="<u8",
    )
    counts = np.zeros(_BITS, np.int64)
    for part in range(0, len(hashes), 65_536):
        chunk = np.ascontiguousarray(hashes[part : part + 65_536])
        bits = np.unpackbits(chunk.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += np.add.reduce(bits, axis=0, dtype=np.int32)
    majority = np.packbits(2 * counts > len(hashes), bitorder="little")
    return int(majority.view("<u8")[0])


def fingerprints(text: Column, shingle_words: int = SHINGLE_WORDS) -> Column:
    """The fingerprint of each text as a (signed) long."""

    @pandas_udf("long")
    def fingerprint(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            values = [fingerprint_of(text, shingle_words) for text in texts]
            yield pd.Series(np.array(values, np.uint64).view(np.int64))

    return fingerprint.asNondeterministic()(text)


def variants(max_bits: int, low: int = 0, high: int = _BITS) -> list[tuple[int, int]]:
    """Pairs (bits kept, bits flipped) that make the keys of a fingerprint, over bits low to high - 1.

    With an even radius r all variants within r / 2 of a fingerprint are keys: two fingerprints at
    most r apart share one, halfway between them. An odd radius is made even by erasing a block: of
    three blocks, the one with the most differing bits holds one at least, so the rest differs in
    r - 1 bits at most.
    """
    width = high - low
    if max_bits % 2:
        cuts = [low + width * i // 3 for i in range(4)]
        erased = [set(range(i, j)) for i, j in zip(cuts, cuts[1:])]
    else:
        erased = [set()]
    keys = []
    for block in erased:
        rest = [bit for bit in range(low, high) if bit not in block]
        kept = sum(1 << bit for bit in rest)
        for flips in range(max_bits // 2 + 1):
            keys += [(kept, sum(1 << b for b in chosen)) for chosen in combinations(rest, flips)]
    return keys


def _signed(value: int) -> int:
    return value - (1 << _BITS) if value >> (_BITS - 1) else value


def _exploded(keys: list[tuple[int, int]]) -> Column:
    rows = [F.struct(F.lit(_signed(k)).alias("kept"), F.lit(_signed(f)).alias("flip")) for k, f in keys]
    return F.explode(F.array(*rows))


def near_pairs(nodes: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Links ``a``, ``b`` between the distinct longs in ``fp`` that connect all at most max_bits apart.

    Every fingerprint emits its keys, the keys are shuffled and sorted, and all fingerprints of a key
    are compared in the one task that has them; each key returns a spanning forest of its links, not
    all its pairs. A key has few fingerprints unless very many differ in the erased bits alone; one
    with more than ``GROUP_LIMIT`` is emitted again, under keys made from its erased bits too, which
    leaves at most some ten thousand that can share a key.
    """
    keyed = nodes.select("fp", _exploded(variants(max_bits)).alias("v")).select(
        (F.col("fp").bitwiseAND(F.col("v.kept"))).bitwiseXOR(F.col("v.flip")).alias("key"), "fp"
    )
    first = stored(_compared(keyed, max_bits, GROUP_LIMIT))
    blocks = [_exploded(variants(max_bits, i, j)) for i, j in _erasable(max_bits)]
    again = first.where("again").select(F.col("a").alias("key"), F.col("b").alias("fp"))
    links = first.where("not again").select("a", "b")
    for block in blocks:
        finer = again.select("key", "fp", block.alias("v")).select(
            F.xxhash64("key", F.col("fp").bitwiseAND(F.col("v.kept")).bitwiseXOR(F.col("v.flip"))).alias("key"),
            "fp",
        )
        links = links.union(_compared(finer, max_bits, None).select("a", "b"))
    # A fingerprint may meet itself under a key that two erasures share.
    return links.where("a != b").distinct()


def _erasable(max_bits: int) -> list[tuple[int, int]]:
    if max_bits % 2 == 0:
        return []
    cuts = [_BITS * i // 3 for i in range(4)]
    return list(zip(cuts, cuts[1:]))


def _compared(keyed: DataFrame, max_bits: int, limit: int | None) -> DataFrame:
    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_key, held, size = None, [], 0
        for batch in batches:
            if batch.num_rows == 0:
                continue
            keys, fps = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            cuts = np.flatnonzero(keys[1:] != keys[:-1]) + 1
            starts, stops = np.concatenate([[0], cuts]), np.concatenate([cuts, [len(keys)]])
            found, first = [], 0
            if held_key is not None and keys[0] == held_key:
                first = 1
                held.append(fps[: stops[0]])
                size += int(stops[0])
            if first < len(starts):
                if held and limit is not None and size > limit:
                    # The key's earlier rows may be emitted already: its last ones must follow them.
                    yield _rows(*_same_key(held_key, held), True)
                elif held:
                    found.append(_forest(np.concatenate(held), max_bits))
                sizes = stops[first:-1] - starts[first:-1]
                twos = starts[first:-1][sizes == 2]
                near = _distance(fps[twos], fps[twos + 1]) <= max_bits
                found.append((fps[twos][near], fps[twos + 1][near]))
                for i in np.flatnonzero(sizes > 2):
                    group = fps[starts[first + i] : stops[first + i]]
                    found.append(_forest(group, max_bits))
                held_key, held, size = keys[-1], [fps[starts[-1] :]], int(stops[-1] - starts[-1])
            if limit is not None and size > limit:
                if held:
                    yield _rows(*_same_key(held_key, held), True)
                held = []
            if found:
                a, b = (np.concatenate([pair[i] for pair in found]) for i in (0, 1))
                if len(a):
                    pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], 1), axis=0)
                    yield _rows(pairs[:, 0], pairs[:, 1], False)
        if held:
            yield _rows(*_forest(np.concatenate(held), max_bits), False)

    return (
        keyed.repartition("key").sortWithinPartitions("key").mapInArrow(
            links, "a long, b long, again boolean"
        )
    )


def _same_key(key: int, held: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    fresh = np.concatenate(held)
    return np.full(len(fresh), key), fresh


def _rows(a: np.ndarray, b: np.ndarray, again: bool) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(np.full(len(a), again))],
        names=["a", "b", "again"],
    )


def _distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a.view(np.uint64) ^ b.view(np.uint64))


def _forest(values: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect those of ``values`` which steps of at most ``max_bits`` connect."""
    rest = np.unique(values)
    a, b = [], []
    while len(rest) > 1:
        frontier, rest = [rest[0]], rest[1:]
        while frontier and len(rest):
            at = frontier.pop()
            near = _distance(rest, np.full(1, at)) <= max_bits
            if near.any():
                found = rest[near]
                rest = rest[~near]
                a.append(np.full(len(found), at))
                b.append(found)
                frontier.extend(found)
    none = np.zeros(0, np.int64)
    return np.concatenate(a or [none]), np.concatenate(b or [none])


def near_duplicates(
    docs: DataFrame, shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS
) -> DataFrame:
    """``doc_id``, ``fp`` and ``component_id`` for each row of ``docs`` (``doc_id``, ``text``).

    Fingerprints at most ``max_bits`` apart link, over any number of steps; ``component_id`` is the
    smallest linked ``doc_id``. Texts without words (null, empty, white space) have fingerprint zero and
    link like any other. Rows with the same text are compared once, as one fingerprint, so groups of
    copies of any size cost one row after the partial aggregate. A row without id gets the smallest id
    of its group, null if the group has none. Repeated ids and rows keep their rows.
    """
    prints = stored(docs.select("doc_id", fingerprints(F.col("text"), shingle_words).alias("fp")))
    nodes = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("low")))
    named = _lowest(nodes, max_bits).withColumnRenamed("lowest", "component_id")
    return prints.join(named, "fp").select("doc_id", "fp", "component_id")


def _lowest(nodes: DataFrame, max_bits: int) -> DataFrame:
    """``fp`` and ``lowest``, the smallest ``low`` of its group, for the distinct ``fp`` of ``nodes``."""
    linked = connected_components(near_pairs(nodes, max_bits))
    classed = nodes.join(linked.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", F.coalesce("component", "fp").alias("class"), "low"
    )
    classed = stored(classed)
    lowest = stored(classed.groupBy("class").agg(F.min("low").alias("lowest")))
    return stored(classed.join(lowest, "class").select("fp", "lowest"))


def hex_fingerprint(fp: Column) -> Column:
    """16 lower-case hexadecimal digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def keep_one(
    docs: DataFrame, shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS
) -> DataFrame:
    """One row of ``docs`` of each group of near-duplicates: the one with the smallest id.

    Rows without id are last, and of rows with the same id the first of the stored rows stays. Rows are
    told apart by their place, so an id that names unrelated texts stays with each of their groups.
    """
    rows = numbered(docs)
    at = F.struct(F.col("row.doc_id").isNull().alias("none"), F.col("row.doc_id").alias("doc_id"), "number")
    prints = stored(rows.select(at.alias("at"), fingerprints(F.col("row.text"), shingle_words).alias("fp")))
    nodes = stored(prints.groupBy("fp").agg(F.min("at").alias("low")))
    grouped = prints.join(_lowest(nodes, max_bits), "fp")
    copies = stored(grouped.where("at.number != lowest.number").select("at.number"))
    return rows.join(copies, "number", "left_anti").select("row.*")
