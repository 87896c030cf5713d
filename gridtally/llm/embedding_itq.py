"""Near-duplicate vectors by iterative quantisation and multi-index Hamming tables."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from gridtally.llm.common import stored
from gridtally.llm.components import connected_components

MIN_COSINE = 0.93
# The rotations are fitted on at most so many vectors, those with the smallest hashes.
FIT_ROWS = 4_096
BITS = 64
TABLES = 4
# Codes further apart than this are not compared as vectors: at the smallest cosine, 64 bits differ in
# 8 on average, with a standard deviation under 3.
MAX_BITS = 20
# The share of pairs at the smallest cosine that must meet in a table, measured when fitting.
MIN_FOUND = 0.95
# A key with more vectors than this is split among tasks, in pairs of parts.
KEY_ROWS = 2_000

_WIDTH = BITS // TABLES


def fit_rotation(
    vectors: np.ndarray, bits: int = BITS, min_cosine: float = MIN_COSINE, seed: int = 5
) -> tuple[np.ndarray, np.ndarray]:
    """The shift and the projection of unit vectors; the signs of the shifted and projected are the code.

    Signs about the mean are balanced, so few vectors share a key. But where all vectors lie in one
    direction, they tell linked vectors apart too. So as much of the mean is taken off as leaves partners made
    for the vectors, exactly at ``min_cosine``, found with a share of ``MIN_FOUND``; at worst nothing.
    """
    rng = np.random.default_rng(seed)
    across = rng.normal(size=vectors.shape)
    across -= (across * vectors).sum(1, keepdims=True) * vectors
    across /= np.sqrt((across * across).sum(1, keepdims=True)) + 1e-300
    partners = min_cosine * vectors + np.sqrt(1 - min_cosine**2) * across
    mean = vectors.mean(0)
    for share in (1.0, 0.75, 0.5, 0.25, 0.0):
        shift = share * mean
        turn = _turned(vectors - shift, bits, seed)
        one, other = ((side - shift) @ turn >= 0 for side in (vectors, partners))
        if not share or _meet(one != other).mean() >= MIN_FOUND:
            return shift, turn
    raise AssertionError


def _turned(vectors: np.ndarray, bits: int, seed: int, rounds: int = 30) -> np.ndarray:
    """The vectors' main directions, turned so that signs lie as near to the values as can be.

    Signs and rotation are improved in turn. Vectors with fewer dimensions than ``bits`` are turned several
    times, each from another start, until the bits are full.
    """
    _, _, directions = np.linalg.svd(vectors, full_matrices=False)
    main = directions[:bits].T
    values = vectors @ main
    turns = []
    for start in range(-(-bits // main.shape[1])):
        rotation = np.linalg.qr(np.random.default_rng(seed + start).normal(size=(main.shape[1],) * 2))[0]
        for _ in range(rounds):
            signs = np.where(values @ rotation >= 0, 1.0, -1.0)
            u, _, w = np.linalg.svd(signs.T @ values)
            rotation = (u @ w).T
        turns.append(main @ rotation)
    return np.hstack(turns)[:, :bits]


def _meet(differ: np.ndarray) -> np.ndarray:
    """Whether codes that differ in these bits are compared as vectors."""
    tables = differ.reshape(len(differ), TABLES, _WIDTH).sum(2)
    return (tables <= 2).any(1) & (tables.sum(1) <= MAX_BITS)


def fit_codes(
    nodes: DataFrame, min_cosine: float = MIN_COSINE, rows: int = FIT_ROWS
) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """A shift and rotation for each length of vectors in the sample that has enough of them."""
    sample = nodes.select("vec").orderBy(F.xxhash64("vec"), "vec").limit(rows).toPandas()
    by_length: dict[int, list] = {}
    for vector in sample["vec"]:
        by_length.setdefault(len(vector), []).append(_unit(np.asarray(vector, dtype=float)))
    return {
        length: fit_rotation(np.array(vectors), BITS, min_cosine)
        for length, vectors in by_length.items()
        if len(vectors) >= 2 * length
    }


def _unit(vector: np.ndarray) -> np.ndarray:
    largest = np.abs(vector).max()
    scaled = vector / largest
    return scaled / np.sqrt(scaled @ scaled)


def codes(vec: Column, rotations: dict[int, tuple[np.ndarray, np.ndarray]]) -> Column:
    """The code of each vector as a long; one of a length that was not fitted uses its first signs."""

    @pandas_udf("long")
    def coded(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for vectors in batches:
            found = []
            for vector in vectors:
                unit = _unit(np.asarray(vector, dtype=float))
                shift, turn = rotations.get(len(unit), (0.0, None))
                values = (unit - shift) @ turn if turn is not None else unit[:BITS]
                bits = np.zeros(BITS, np.uint8)
                bits[: len(values)] = values >= 0
                found.append(np.packbits(bits, bitorder="little").view("<i8")[0])
            yield pd.Series(found, dtype="int64")

    return coded.asNondeterministic()(vec)


def usable(vec: Column) -> Column:
    """Whether a vector has a direction: not null, not empty or zero, all components finite."""
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vec, lambda x: x != 0), F.lit(False))


def near_pairs(nodes: DataFrame, min_cosine: float, key_rows: int = KEY_ROWS) -> DataFrame:
    """``a`` and ``b``, ids of distinct vectors of one label with at least this cosine.

    ``nodes`` has ``vec_id``, ``label``, ``vec`` and ``code``. A table per 16 bits of the code: two
    vectors meet in it if those bits differ in two places at most, since each is entered under all
    variants one place away. A pair is compared only under the first key it shares, and the vectors only
    if the codes are near. A key with many vectors is cut into parts, and each pair of parts is a task's.
    """
    places = [0] + [1 << bit for bit in range(_WIDTH)]
    entries = F.array(
        *(
            F.struct(F.lit(t).alias("t"), F.lit(flip).cast("long").alias("flip"))
            for t in range(TABLES)
            for flip in places
        )
    )
    entered = nodes.select("vec_id", "label", F.size("vec").alias("length"), "code", F.explode(entries).alias("e"))
    bits = F.expr(f"shiftrightunsigned(code, e.t * {_WIDTH}) & {(1 << _WIDTH) - 1}")
    keyed = entered.select(
        "vec_id", "label", "length", "code", F.col("e.t").alias("t"), bits.bitwiseXOR(F.col("e.flip")).alias("bits")
    )
    key = ["label", "length", "t", "bits"]
    heavy = stored(
        keyed.groupBy(*key).count().where(F.col("count") > key_rows)
        .select(*key, F.ceil(F.col("count") / key_rows).cast("int").alias("parts"))
    )
    parted = keyed.join(heavy, key, "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    part = F.pmod(F.xxhash64("vec_id"), F.col("parts")).cast("int")
    met = parted.withColumn("part", part).select(
        "*", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other")
    )
    met = met.select(
        *key, F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"),
        "part", "vec_id", "code",
    )
    group = [*key, "low", "high"]
    near = (
        met.repartition(*group).sortWithinPartitions(*group).mapInArrow(_compare, "a long, b long")
    )
    left = nodes.select(F.col("vec_id").alias("a"), F.col("vec").alias("x"))
    right = nodes.select(F.col("vec_id").alias("b"), F.col("vec").alias("y"))
    return near.join(left, "a").join(right, "b").where(_cosine("x", "y") >= min_cosine).select("a", "b")


def _cosine(x: str, y: str) -> Column:
    @pandas_udf("double")
    def cosine(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for xs, ys in batches:
            yield pd.Series(
                [_unit(np.asarray(a, dtype=float)) @ _unit(np.asarray(b, dtype=float)) for a, b in zip(xs, ys)],
                dtype="float64",
            )

    return cosine.asNondeterministic()(F.col(x), F.col(y))


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = np.stack([batch.column(i).to_numpy().astype(np.int64) for i in range(9)], 1)
        if held is not None:
            rows = np.concatenate([held, rows])
        cuts = np.flatnonzero((rows[1:, :6] != rows[:-1, :6]).any(1)) + 1
        starts = [0, *cuts.tolist()]
        yield from _pairs(rows[: starts[-1]], starts)
        held = rows[starts[-1] :]
    if held is not None:
        yield from _pairs(held, [0, len(held)])


def _pairs(rows: np.ndarray, starts: list[int]) -> Iterator[pa.RecordBatch]:
    """Pairs of the groups that begin at ``starts``, in blocks of bounded size."""
    found_a, found_b, size = [], [], 0
    for i, j in zip(starts, starts[1:]):
        if j - i < 2:
            continue
        group = rows[i:j]
        table, key, low, high = (int(v) for v in group[0, 2:6])
        part, ids, code = group[:, 6], group[:, 7], group[:, 8].view(np.uint64)
        first = np.flatnonzero(part == low)
        second = np.flatnonzero(part == high)
        for at in range(0, len(first), 256):
            a = np.repeat(first[at : at + 256], len(second))
            b = np.tile(second, len(first[at : at + 256]))
            once = ids[a] < ids[b] if low == high else ids[a] != ids[b]
            a, b = a[once], b[once]
            apart = code[a] ^ code[b]
            near = np.bitwise_count(apart) <= MAX_BITS
            a, b, apart = a[near], b[near], apart[near]
            own = np.ones(len(a), bool)
            for t in range(table + 1):
                differ = (apart >> np.uint64(t * _WIDTH)) & np.uint64((1 << _WIDTH) - 1)
                if t < table:
                    own &= np.bitwise_count(differ) > 2
                else:
                    own &= _first_key(code[a] >> np.uint64(t * _WIDTH) & np.uint64((1 << _WIDTH) - 1), differ) == key
            found_a.append(ids[a[own]])
            found_b.append(ids[b[own]])
            size += int(own.sum())
            if size >= 10_000:
                yield _batch(found_a, found_b)
                found_a, found_b, size = [], [], 0
    if size:
        yield _batch(found_a, found_b)


def _first_key(bits: np.ndarray, differ: np.ndarray) -> np.ndarray:
    """The smallest of the keys at most one place from both ``bits`` and ``bits ^ differ``.

    Equal bits are taken under themselves; bits one place apart share both, bits two apart the two
    halfway.
    """
    count = np.bitwise_count(differ)
    lowest = differ & (~differ + np.uint64(1))
    one = np.minimum(bits, bits ^ differ)
    two = np.minimum(bits ^ lowest, bits ^ (differ ^ lowest))
    return np.where(count == 0, bits, np.where(count == 1, one, two)).astype(np.int64)


def _batch(a: list[np.ndarray], b: list[np.ndarray]) -> pa.RecordBatch:
    x, y = np.concatenate(a), np.concatenate(b)
    return pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], names=["a", "b"])


def near_duplicates(vectors: DataFrame, min_cosine: float = MIN_COSINE) -> DataFrame:
    """``vec_id``, ``n_links`` and ``component_id`` for each row of ``vec_id``, ``embedding``, ``label``.

    Equal vectors of one label are one node, compared once and counted as often as they occur. A row
    links with nothing, and is its own component, if its label is null or its vector is null, empty,
    zero, or has a null or non-finite component. Vectors of different lengths never link. A row without
    id is counted in others' links and gets the smallest id of its component. Rows that repeat an id are
    vectors of their own, so nodes are numbered apart from the ids.
    """
    named = vectors.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("vec"))
    rows = stored(named.withColumn("usable", F.col("label").isNotNull() & usable(F.col("vec"))))
    grouped = stored(
        rows.where("usable")
        .groupBy("label", "vec")
        .agg(F.count("*").alias("copies"), F.min("vec_id").alias("low"))
        .withColumn("vec_id", F.monotonically_increasing_id())
    )
    rotations = fit_codes(grouped, min_cosine)
    nodes = stored(grouped.withColumn("code", codes(F.col("vec"), rotations)))
    links = stored(near_pairs(nodes, min_cosine).distinct())
    both = links.union(links.select("b", "a"))
    copies = nodes.select(F.col("vec_id").alias("b"), "copies")
    beside = both.join(copies, "b").groupBy("a").agg(F.sum("copies").alias("near"))
    found = connected_components(links)
    classed = stored(
        nodes.join(beside, nodes["vec_id"] == beside["a"], "left")
        .join(found, nodes["vec_id"] == found["node"], "left")
        .select(
            "label", "vec", "low",
            F.coalesce("component", "vec_id").alias("class"),
            (F.coalesce("near", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        )
    )
    lowest = stored(classed.groupBy("class").agg(F.min("low").alias("component_id")))
    result = stored(classed.join(lowest, "class").select("label", "vec", "n_links", "component_id"))
    linked = rows.where("usable").join(result, ["label", "vec"]).select("vec_id", "n_links", "component_id")
    alone = rows.where("not usable").select("vec_id", F.lit(0).cast("long"), F.col("vec_id"))
    return linked.union(alone)
