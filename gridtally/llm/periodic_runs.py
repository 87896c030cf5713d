"""Periodic runs of words: stretches in which the same few words follow each other again and again.

A text's suffixes are sorted, and the intervals of suffixes with a common beginning form a tree. It is
walked from its leaves. Each interval keeps the starts of its suffixes in order, each start in the class
of the word to its left. Where two child intervals meet, a start of one and a start of the other share
exactly the words of the interval; if their classes differ too, they are a maximal pair. If the distance
d of a maximal pair is so small that the shared words l reach ``(exponent - 1) * d``, the l + d words from
the first start on are a run with period d: both its ends are ends already, nothing is extended.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

MIN_LENGTH = 6
MIN_EXPONENT = 4

_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_FOUND = pa.struct([("runs", pa.list_(_RUN)), ("collapsed", pa.string())])
_DDL = "struct<runs: array<struct<start: bigint, length: bigint, period: bigint>>, collapsed: string>"

Run = tuple[int, int, int]


def seed_length(min_length: int = MIN_LENGTH, exponent: int = MIN_EXPONENT) -> int:
    """The fewest words the two starts of a run can share: all shorter intervals are left out."""
    return min(max((exponent - 1) * d, min_length - d, 1) for d in range(1, min_length + 1))


def runs(words: Sequence, min_length: int = MIN_LENGTH, exponent: int = MIN_EXPONENT) -> list[Run]:
    """``(start, length, period)`` of all runs, by start, then period.

    A run has the smallest period its words have, at least ``min_length`` words and ``exponent`` periods,
    and no neighbouring word continues it. ``exponent`` is at least 3. Time is of the order of n log n.
    """
    if exponent < 3:
        raise ValueError("runs of fewer than three periods are not found by their nearest starts")
    if len(words) < min_length:
        return []
    ids: dict = {}
    numbers = [ids.setdefault(word, len(ids) + 1) for word in words]
    seed = seed_length(min_length, exponent)
    names = _grams(np.array(numbers, dtype=np.int64), seed)
    counts = np.bincount(names)
    if counts.max() < 2:
        return []
    order, rank = _suffixes(names, counts, seed)
    active = np.flatnonzero(counts[names] > 1).tolist()
    order, rank, names = order.tolist(), rank.tolist(), names.tolist()
    numbers.append(0)
    shared = _shared(numbers, order, rank, names, active, seed)
    shortest: dict[tuple[int, int], int] = {}
    for length, one, other in _meetings(order, shared, sorted(rank[i] for i in active)):
        reach = length // (exponent - 1)
        for low, high in _pairs(one, other, reach):
            # Position 0 has no word to its left, which no other start shares: numbers[-1] is 0.
            if numbers[low - 1] != numbers[high - 1]:
                period = high - low
                key = (low, length + period)
                if key[1] >= min_length and shortest.get(key, period) >= period:
                    shortest[key] = period
    return sorted((start, length, period) for (start, length), period in shortest.items())


def _joined(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Dense numbers for pairs, in the order of the pairs."""
    return np.unique(first * (second.max() + 1) + second, return_inverse=True)[1]


def _grams(numbers: np.ndarray, length: int) -> np.ndarray:
    """For each position a number for the ``length`` words from it on, in the order of those words.

    The end of the text counts as a word before all others, so the last positions have numbers too.
    """
    names, covered = numbers, 1
    while covered < length:
        step = min(covered, length - covered)
        names = _joined(names, np.concatenate([names[step:], np.zeros(step, np.int64)]) + _tail(names, step))
        covered += step
    return names


def _tail(names: np.ndarray, step: int) -> np.ndarray:
    """One for positions followed by a name ``step`` on, zero for those past the end."""
    inside = np.ones(len(names), np.int64)
    inside[-step:] = 0
    return inside


def _suffixes(names: np.ndarray, counts: np.ndarray, covered: int) -> tuple[np.ndarray, np.ndarray]:
    """The starts of all suffixes in order, and the place of each start in that order.

    Groups of suffixes that share ``covered`` words are sorted by the group of the suffix ``covered`` words
    on, which doubles the words they are sorted by; suffixes alone in their group have their place.
    """
    size = len(names)
    order = np.argsort(names, kind="stable")
    first = np.concatenate([[0], np.cumsum(counts)[:-1]])
    rank = first[names]
    open_ = np.flatnonzero(counts[names[order]] > 1)
    while len(open_):
        starts = order[open_]
        group, after = rank[starts], starts + covered
        key = np.where(after < size, rank[np.minimum(after, size - 1)], -1)
        by = np.lexsort((key, group))
        starts, group, key = starts[by], group[by], key[by]
        order[open_] = starts
        new = np.concatenate([[True], (group[1:] != group[:-1]) | (key[1:] != key[:-1])])
        heads = np.flatnonzero(new)
        rank[starts] = np.repeat(open_[heads], np.diff(np.append(heads, len(starts))))
        single = new & np.append(new[1:], True)
        open_ = open_[~single]
        covered *= 2
    return order, rank


def _shared(numbers: list, order: list, rank: list, names: list, active: list, seed: int) -> dict[int, int]:
    """For each place in the order the words its suffix shares with the one before, if at least ``seed``."""
    shared: dict[int, int] = {}
    length, last = 0, -2
    for start in active:
        length = max(length - 1 if last == start - 1 else 0, seed)
        last = start
        place = rank[start]
        before = order[place - 1] if place else start
        if before == start or names[before] != names[start]:
            length = 0
            continue
        while numbers[start + length] == numbers[before + length]:
            length += 1
        shared[place] = length
    return shared


def _meetings(order: list, shared: dict, places: list) -> Iterator[tuple[int, list, list]]:
    """The tree of intervals from its leaves: the words of an interval, and the starts of two children.

    ``places`` are the places in the order whose suffixes share the fewest words of a run with another,
    rising. The larger list of starts is yielded first; afterwards the smaller is merged into it, so a start
    is moved a logarithmic number of times.
    """
    stack: list[tuple[int, list]] = []
    child: list = []
    for place in [*places, None]:
        length = shared.get(place, 0)
        while stack and stack[-1][0] > length:
            words, starts = stack.pop()
            large, small = _by_size(starts, child)
            yield words, large, small
            child = _merged(large, small)
        if length and stack and stack[-1][0] == length:
            large, small = _by_size(stack.pop()[1], child)
            yield length, large, small
            child = _merged(large, small)
        if length:
            stack.append((length, child))
        if place is not None:
            child = [order[place]]


def _by_size(one: list, other: list) -> tuple[list, list]:
    return (one, other) if len(one) >= len(other) else (other, one)


def _merged(large: list, small: list) -> list:
    if len(small) * 8 < len(large):
        for start in small:
            insort(large, start)
    else:
        large.extend(small)
        large.sort()
    return large


def _pairs(large: list, small: list, reach: int) -> Iterator[tuple[int, int]]:
    """Each start of ``small`` with the nearest of ``large`` on both sides, if within ``reach``.

    Shared words of three distances repeat with that distance, so the starts of an interval that are so
    near to each other are equally far apart. All but the first of them are of one class, and only its
    nearest neighbour makes the run of smallest period; farther ones give multiples of that period.
    """
    for start in small:
        at = bisect_left(large, start)
        if at and start - large[at - 1] <= reach:
            yield large[at - 1], start
        if at < len(large) and large[at] - start <= reach:
            yield start, large[at]


def kept_words(words: Sequence, found: Sequence[Run]) -> list:
    """``words`` without the repeats: what follows the first period of each run is left out."""
    if not found:
        return list(words)
    keep = np.ones(len(words), bool)
    for start, length, period in found:
        keep[start + period : start + length] = False
    return [words[i] for i in np.flatnonzero(keep)]


def find_runs(text: Column, min_length: int = MIN_LENGTH, exponent: int = MIN_EXPONENT) -> Column:
    """Per text a struct: ``runs``, an array of ``start``, ``length``, ``period``, and ``collapsed``.

    Words are what stands between ASCII white space, numbered from 0. ``collapsed`` is the text with one
    period kept of each run, its words joined by single spaces. Null and empty texts, and texts of white
    space, have no runs and collapse to the empty text. Texts are handled whole and one by one, so a task
    holds the tables of its longest text at most.
    """

    @F.arrow_udf(_DDL)
    def found(texts: pa.Array) -> pa.Array:
        rows = []
        for value in texts:
            words = (value.as_py() or "").encode().split()
            own = runs(words, min_length, exponent)
            collapsed = b" ".join(kept_words(words, own) if own else words).decode()
            rows.append(([{"start": s, "length": n, "period": p} for s, n, p in own], collapsed))
        lists = pa.array([row[0] for row in rows], pa.list_(_RUN))
        return pa.StructArray.from_arrays(
            [lists, pa.array([row[1] for row in rows], pa.string())], fields=list(_FOUND)
        )

    return found(text)


def strongest(found: Column) -> Column:
    """Of an array of runs in order the one with most periods; of equals the first. Null if there is none."""
    none = F.lit(None).cast("struct<start: bigint, length: bigint, period: bigint>")
    more = lambda best, run: best.isNull() | (run["length"] * best["period"] > best["length"] * run["period"])
    return F.reduce(found, none, lambda best, run: F.when(more(best, run), run).otherwise(best))
