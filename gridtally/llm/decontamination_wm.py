"""Benchmark passages in documents, by the multi-pattern search of Wu and Manber over words."""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from gridtally.llm.common import stored

WINDOW_WORDS = 13
# A document is contaminated if at least one word in so many is part of a benchmark window.
ONE_IN = 20
# Benchmarks are searched in sets of about so many bytes of text, whose tables take about a hundred
# times that; each set is broadcast on its own.
SET_BYTES = 1 << 20

# Every byte as part of a word (A-Z in lower case) or as a gap.
_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def words(text: str | None) -> list[bytes]:
    """The lower-case words of a text: runs of ASCII letters, digits and all other characters."""
    return text.encode().translate(_BYTES).split() if text else []


def windows(text: str | None, size: int = WINDOW_WORDS) -> list[tuple[bytes, ...]]:
    """All runs of ``size`` words; a text of fewer words, but not none, is one window."""
    found = words(text)
    if not found:
        return []
    width = min(size, len(found))
    return [tuple(found[i : i + width]) for i in range(len(found) - width + 1)]


class Search:
    """The tables for test strings of one length.

    A block is two words (one, for strings of one word). ``shift`` says how far the search may move on
    after a block: to where the block would stand further left in some string, or past it if it is in
    none. Strings that end with a block are in its bucket.
    """

    def __init__(self, strings: dict[tuple[bytes, ...], list]):
        self.length = len(next(iter(strings)))
        self.block = min(2, self.length)
        self.skip = self.length - self.block + 1
        self.shift: dict = {}
        self.bucket: dict = {}
        for string, items in strings.items():
            for end in range(self.block, self.length + 1):
                block = string[end - self.block : end] if self.block == 2 else string[end - 1]
                move = self.length - end
                if move < self.shift.get(block, self.skip):
                    self.shift[block] = move
            tail = string[-2:] if self.block == 2 else string[-1]
            self.bucket.setdefault(tail, []).append((list(string), items))

    def ends(self, text: list[bytes]) -> Iterator[tuple[int, list]]:
        """The end and the items of every occurrence."""
        at, length, skip, size = self.length - 1, self.length, self.skip, len(text)
        shift = self.shift.get
        pairs = self.block == 2
        while at < size:
            block = (text[at - 1], text[at]) if pairs else text[at]
            move = shift(block, skip)
            if move:
                at += move
                continue
            for string, items in self.bucket.get(block, ()):
                if text[at - length + 1 : at + 1] == string:
                    yield at + 1, items
            at += 1


def tables(strings: dict[tuple[bytes, ...], list]) -> list[Search]:
    """The searches for test strings, one for each length."""
    by_length: dict[int, dict] = {}
    for string, items in strings.items():
        by_length.setdefault(len(string), {})[string] = items
    return [Search(group) for _, group in sorted(by_length.items())]


def search(text: list[bytes], searches: list[Search]) -> tuple[list[tuple[int, int]], set]:
    """The runs of words that occurrences cover, disjoint and in order, and the items found."""
    spans, items = [], set()
    for one in searches:
        for end, found in one.ends(text):
            spans.append((end - one.length, end))
            items.update(found)
    return merged(spans), items


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Disjoint runs that cover the same places."""
    runs: list[list[int]] = []
    for start, end in sorted(spans):
        if runs and start <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], end)
        else:
            runs.append([start, end])
    return [tuple(run) for run in runs]


def find_benchmark(docs: DataFrame, benchmark: DataFrame, set_bytes: int = SET_BYTES) -> DataFrame:
    """``docs`` with ``n_words``, ``runs`` of hit words (start, end), and ``items`` found, sorted.

    The texts of the benchmark (``item_id``, ``text``) and their ids are measured first. They are searched in
    as many sets as keep each near ``set_bytes``, also where one text has very many ids, and only one set at a time is on the driver and broadcast. With
    several, the documents are stored once and read for each set, which stores its hits alone; the hits of
    a document are then put together. Windows that several items share count for each. Items without
    words, and null texts on either side, match nothing; an item without id hits words but is not listed.
    Repeated rows count once. Columns of these names in ``docs`` are replaced.
    """
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), "text").where("text is not null")
    own_bytes = F.octet_length("text") + F.coalesce(F.octet_length("item"), F.lit(0))
    total = items.distinct().agg(F.sum(own_bytes)).first()[0] or 0
    sets = max(1, -(-total // set_bytes))
    found = docs.drop("n_words", "runs", "items")
    columns = found.columns
    if sets == 1:
        name = "_set"
        while name in columns:
            name += "_"
        one = found.withColumn(name, _scan(_strings(items))("text"))
        return one.select(*columns, f"{name}.n_words", f"{name}.runs", f"{name}.items")
    numbered = stored(
        found.select(F.struct(*columns).alias("row"), F.monotonically_increasing_id().alias("number"))
    )
    hits = None
    for number in range(sets):
        own = items.where(F.pmod(F.xxhash64("text", "item"), F.lit(sets)) == number)
        scanned = numbered.select("number", _scan(_strings(own))("row.text").alias("_set"))
        met = stored(scanned.select("number", "_set.runs", "_set.items").where(F.size("runs") > 0))
        hits = met if hits is None else hits.union(met)
    listed = hits.groupBy("number").agg(
        F.flatten(F.collect_list("runs")).alias("runs"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )
    no_runs = F.array().cast("array<struct<start:bigint,end:bigint>>")
    return (
        numbered.select("row", "number", _scan(_broadcast(docs, {}))("row.text")["n_words"].alias("n_words"))
        .join(listed.select("number", _join_runs("runs").alias("runs"), "items"), "number", "left")
        .select(
            "row.*", "n_words", F.coalesce("runs", no_runs).alias("runs"),
            F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        )
    )


def _broadcast(frame: DataFrame, strings: dict):
    return frame.sparkSession.sparkContext.broadcast(strings)


def _strings(items: DataFrame):
    """The broadcast windows of ``items``, each with the sorted items that hold it."""
    strings: dict[tuple[bytes, ...], set] = {}
    for item, text in items.distinct().collect():
        for string in windows(text):
            strings.setdefault(string, set()).update([] if item is None else [item])
    return _broadcast(items, {s: sorted(ids) for s, ids in strings.items()})


def _join_runs(column):
    @pandas_udf("array<struct<start:long,end:long>>")
    def join(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for rows in batches:
            yield pd.Series(
                [
                    [{"start": i, "end": j} for i, j in merged([(r["start"], r["end"]) for r in runs])]
                    for runs in rows
                ]
            )

    return join.asNondeterministic()(column)


def _scan(shared):
    @pandas_udf("n_words long, runs array<struct<start:long,end:long>>, items array<string>")
    def scan(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        searches = tables(shared.value)
        for texts in batches:
            counts, runs, items = [], [], []
            for text in texts:
                found = words(text)
                spans, hit = search(found, searches)
                counts.append(len(found))
                runs.append([{"start": i, "end": j} for i, j in spans])
                items.append(sorted(hit))
            yield pd.DataFrame({"n_words": counts, "runs": runs, "items": items})

    return scan.asNondeterministic()


def hit_words(runs):
    """How many words the runs cover."""
    return F.aggregate(runs, F.lit(0).cast("long"), lambda n, run: n + run["end"] - run["start"])


def is_contaminated(n_hit, n_words, one_in: int = ONE_IN):
    """Whether the hit words are enough to count."""
    return (n_hit > 0) & (n_hit * one_in >= n_words)


def keep_clean(docs: DataFrame, benchmark: DataFrame, one_in: int = ONE_IN) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with the columns they had."""
    found = find_benchmark(docs.select(F.struct(*docs.columns).alias("row"), "text"), benchmark)
    hit = hit_words(F.col("runs"))
    return found.where(~is_contaminated(hit, F.col("n_words"), one_in)).select("row.*")


def items_digest(items: list[str]) -> str:
    """Hex SHA-256 of the sorted items, comma-joined."""
    return sha256(",".join(sorted(items)).encode()).hexdigest()
