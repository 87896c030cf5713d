"""A filter of fixed size for keys: lets all rows with a wanted key pass, and a share of the others.

Every wanted key sets one bit of a bitmap, at the place its hash names. The bitmap is a table of 64-bit
words, so it never has more rows than words, however many keys there are, and may always be broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridtally.storage import free_name

# 2 ** 26 bits are about a million words, some 32 MB broadcast. Of the rows with other keys a share of
# about (wanted keys / bits) passes.
BITS = 1 << 26
_WORD = 64


def key_filter(wanted: DataFrame, keys: Sequence[str], bits: int = BITS) -> DataFrame:
    """The bitmap of the ``keys`` of ``wanted``: ``_word`` and ``_bits``, at most ``bits / 64`` rows.

    Repeated keys set the same bit, in the task that reads them already.
    """
    place = F.pmod(F.xxhash64(*keys), F.lit(bits))
    set_ = F.expr(f"shiftleft(1L, int(_place % {_WORD}))")
    # A place is never null, which Spark does not know. Said so, the join with the bitmap adds no filter to what is
    # read of ``wanted``, whose exchanges a plan that uses it once more then shares.
    word = F.coalesce(F.floor(F.col("_place") / _WORD), F.lit(0))
    words = wanted.select(place.alias("_place")).select(word.alias("_word"), set_.alias("_bit"))
    return words.groupBy("_word").agg(F.bit_or("_bit").alias("_bits"))


def mark_filter(
    rows: DataFrame, bitmap: DataFrame, keys: Sequence[str], mark: str, bits: int = BITS
) -> DataFrame:
    """``rows`` plus ``mark``: true if the ``bitmap`` holds the ``keys``, which is so for all wanted ones."""
    place = free_name("_place", rows)
    placed = rows.withColumn(place, F.pmod(F.xxhash64(*keys), F.lit(bits)))
    met = placed.join(F.broadcast(bitmap), F.floor(F.col(place) / _WORD) == F.col("_word"), "left")
    is_set = F.expr(f"shiftrightunsigned(_bits, int({place} % {_WORD})) & 1L") == 1
    return met.select(*rows.columns, F.coalesce(is_set, F.lit(False)).alias(mark))


def pass_filter(rows: DataFrame, bitmap: DataFrame, keys: Sequence[str], bits: int = BITS) -> DataFrame:
    """The rows of ``rows`` whose ``keys`` the ``bitmap`` of as many ``bits`` holds, and few others.

    The keys must have the types they had in ``key_filter``. Null keys are keys like others.
    """
    mark = free_name("_passes", rows)
    return mark_filter(rows, bitmap, keys, mark, bits).where(mark).drop(mark)


def same_type(rows: DataFrame, wanted: DataFrame, key: str) -> bool:
    """Whether ``key`` has the same type in both, so that equal keys have equal hashes."""
    return rows.schema[key].dataType == wanted.schema[key].dataType


def semi_join_by_filter(rows: DataFrame, wanted: DataFrame, key: str, bits: int = BITS) -> DataFrame:
    """``rows.join(wanted, key, "left_semi")`` without an exchange of ``rows``, though ``wanted`` be too long to broadcast.

    The bitmap of ``wanted`` lets few other keys pass. These are listed from ``rows``, of which the key alone is
    read and exchanged for that, and rows that have a listed key are left out. The second bitmap, that of the list,
    has the list counted before the rows are joined to it, so AQE broadcasts the list. Only if that is too long, too,
    which takes many more wanted keys than ``bits``, rows are exchanged by the key, as they would be by the plain join,
    which is taken where the key has two types.
    """
    if not same_type(rows, wanted, key):
        return rows.join(wanted.select(key), key, "left_semi").select(*rows.columns)
    near = pass_filter(rows.where(F.col(key).isNotNull()), key_filter(wanted, [key], bits), [key], bits)
    # Dealt once more, for that exchange is what AQE measures; by a hash, since Spark would leave out one by the key.
    others = near.select(key).distinct().join(wanted, key, "left_anti").repartition(F.xxhash64(key))
    mark, other = free_name("_listed", rows), free_name("_other", rows)
    marked = mark_filter(near, key_filter(others, [key], bits), [key], mark, bits)
    is_other = F.col(mark) & (F.col(key) == F.col(other))
    return marked.join(others.withColumnRenamed(key, other), is_other, "left_anti").select(*rows.columns)
