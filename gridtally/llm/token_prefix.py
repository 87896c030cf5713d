"""Token counts of every prefix of a text, by dynamic programming over its prefixes."""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column
from pyspark.sql.functions import pandas_udf

# Fixed values of byte-level BPE: the pieces a text is split into before merging.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

# What a prefix may split otherwise than the text: all white space before a word, which gives its last
# character to the word in the text; and a contraction of three characters without its last.
GAPS = r"\s{2,}(?=\S)"
SHORTENED = r"'(?:re|ve|ll)"

_MEMO = 300_000
_PAIRS = 1_000_000
# The counts of a piece of so many characters fit a byte each, as a character has four bytes at most.
_MEMO_LETTERS = 32


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a vocabulary file."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [byte for byte in range(256) if byte not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class _Tables(dict):
    """The tables of pieces met before, one byte for each character; the older half is forgotten in turn."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.vocabulary = vocabulary
        self.older: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes | np.ndarray:
        if len(piece) > _MEMO_LETTERS:
            return np.array(self.vocabulary.piece(piece)[1:], np.int32)
        known = self.older.get(piece)
        if known is None:
            known = bytes(self.vocabulary.piece(piece)[1:])
        if len(self) >= _MEMO:
            self.older = dict(self)
            self.clear()
        self[piece] = known
        return known


class Vocabulary:
    """A byte-level BPE vocabulary read from the JSON text of a tokenizer file.

    Special tokens count as one wherever their text occurs, as the file's library does by default.
    """

    def __init__(self, text: str):
        letters = _byte_letters()
        content = json.loads(text)
        model = content["model"]
        self.ids = {
            bytes(letters[c] for c in token): i
            for token, i in model["vocab"].items()
            if all(c in letters for c in token)
        }
        self.bytes_of = {i: token for token, i in self.ids.items()}
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.ranks = {}
        for rank, (left, right) in enumerate(pairs):
            a, b = (bytes(letters[c] for c in part) for part in (left, right))
            self.ranks[self.ids[a], self.ids[b]] = (rank, self.ids[a + b])
        # How each token is made: its parts and the rank of their merge, the first if there are several.
        self.parts: dict[int, tuple[int, int, int]] = {}
        for (a, b), (rank, token) in self.ranks.items():
            self.parts.setdefault(token, (a, b, rank))
        made = lambda token: self.parts[token][2] if token in self.parts else -1
        # Whether parts are always made before what is made of them, as in any trained vocabulary.
        self.rising = all(max(made(a), made(b)) < rank for (a, b), (rank, _) in self.ranks.items())
        self.edges: tuple[dict, dict] = ({}, {})
        # The ends of tokens: the token itself if the end is one, else -1.
        self.ends_of: dict[bytes, int] = {}
        for token, i in self.ids.items():
            for size in range(1, len(token)):
                self.ends_of.setdefault(token[-size:], -1)
            self.ends_of[token] = i
        self.special = [t["content"] for t in content.get("added_tokens", []) if t["content"]]
        self.stable_pairs: dict[tuple[int, int], bool] = {}
        self.tables = _Tables(self)

    @cached_property
    def pattern(self):
        return regex.compile(PIECES)

    @cached_property
    def gaps(self):
        return regex.compile(GAPS)

    @cached_property
    def shortened(self):
        return regex.compile(SHORTENED)

    @cached_property
    def special_pattern(self):
        names = sorted(self.special, key=len, reverse=True)
        return regex.compile("|".join(map(regex.escape, names))) if names else None

    def merged(self, raw: bytes) -> list[int]:
        """Merge a few bytes by rank, for the tests of neighbours."""
        parts = [self.ids[raw[i : i + 1]] for i in range(len(raw))]
        while len(parts) > 1:
            ranked = [
                (self.ranks[pair][0], at)
                for at, pair in enumerate(zip(parts, parts[1:]))
                if pair in self.ranks
            ]
            if not ranked:
                break
            _, at = min(ranked)
            parts[at : at + 2] = [self.ranks[parts[at], parts[at + 1]][1]]
        return parts

    def spine(self, token: int, side: int) -> list[tuple[int, int]]:
        """The tokens at the right (1) or left (0) edge of ``token`` while it is merged, largest first.

        With each, the rank of the merge that uses it up; for the token itself a rank past all others.
        """
        found, used_up = [], len(self.ranks)
        while True:
            found.append((token, used_up))
            made = self.parts.get(token)
            if made is None:
                return found
            token, used_up = made[side], made[2]

    def stable(self, left: int, right: int) -> bool:
        """Whether two tokens next to each other stay as they are when their bytes are merged.

        With -1 on the left, whether the bytes of the right one alone merge to it. Merges go by rising rank,
        and of equal ranks from the left. So a merge across the boundary happens just if its rank comes
        before the ranks that use up its two sides; on the right an equal rank is late enough.
        """
        if len(self.stable_pairs) >= _PAIRS:
            self.stable_pairs.clear()
        if left < 0:
            known = self.merged(self.bytes_of[right]) == [right]
        elif self.rising:
            rank_of = self.ranks.get
            edges = self.edges
            if left not in edges[1]:
                edges[1][left] = self.spine(left, 1)
            if right not in edges[0]:
                edges[0][right] = self.spine(right, 0)
            known = True
            for one, until in edges[1][left]:
                for other, till in edges[0][right]:
                    met = rank_of((one, other))
                    if met is not None and met[0] < until and met[0] <= till:
                        known = False
        else:
            known = self.merged(self.bytes_of[left] + self.bytes_of[right]) == [left, right]
        self.stable_pairs[left, right] = known
        return known

    def counts(self, raw: bytes) -> list[int]:
        """How many tokens each prefix of one piece has; entry i is for the first i bytes.

        The tokens of a prefix are those of a shorter one and a last token, where the last two tokens
        are stable side by side; exactly one last token is. So each entry follows from an earlier one.
        """
        counts, last = [0], [-1]
        end_of, known = self.ends_of.get, self.stable_pairs.get
        for end in range(1, len(raw) + 1):
            start, candidates = end - 1, []
            while start >= 0:
                token = end_of(raw[start:end])
                if token is None:
                    break
                if token >= 0:
                    candidates.append(token)
                    candidates.append(start)
                start -= 1
            while True:  # from the longest token on
                start, token = candidates.pop(), candidates.pop()
                fits = known((last[start], token))
                if fits or fits is None and self.stable(last[start], token):
                    break
            counts.append(counts[start] + 1)
            last.append(token)
        return counts

    def piece(self, piece: str) -> list[int]:
        """``counts`` at the ends of the characters of a piece: entry i is for i characters."""
        raw = piece.encode()
        counts = self.counts(raw)
        if len(raw) != len(piece):
            ends, at = [0], 0
            for char in piece:
                at += len(char.encode())
                ends.append(at)
            counts = [counts[end] for end in ends]
        return counts

    def total(self, text: str) -> int:
        """Tokens of a text without special tokens."""
        return sum(int(self.tables[piece][-1]) for piece in self.pattern.findall(text))

    def plain_prefixes(self, text: str) -> np.ndarray:
        """For each character of a text without special tokens, the tokens of the text up to and with it.

        The tables of the pieces one after the other, each raised by the tokens before it. Where the prefix
        splits otherwise, only what it splits otherwise is looked up again.
        """
        pieces = self.pattern.findall(text)
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        tables = map(self.tables.__getitem__, pieces)
        if lengths.max() <= _MEMO_LETTERS:
            counts = np.frombuffer(b"".join(tables), np.uint8).astype(np.int32)
        else:
            read = (np.frombuffer(t, np.uint8) if isinstance(t, bytes) else t for t in tables)
            counts = np.concatenate(list(read)).astype(np.int32)
        ends = np.cumsum(lengths)
        totals = counts[ends - 1]
        counts += np.repeat(np.cumsum(totals) - totals, lengths).astype(np.int32)
        before = lambda at: int(counts[at - 1]) if at else 0
        for found in self.shortened.finditer(text) if "'" in text else ():
            at = found.start()
            k = int(np.searchsorted(ends, at, "right"))
            if ends[k] == at + 3 and lengths[k] == 3:
                counts[at + 1] = before(at) + self.total("'") + self.total(found.group()[1])
        for gap in self.gaps.finditer(text):
            counts[gap.end() - 1] = before(gap.start()) + self.total(gap.group())
        return counts

    def prefixes(self, text: str | None) -> np.ndarray:
        """The exact token count of every prefix: entry i is for the first i characters, code points."""
        text = text or ""
        marks = [m.span() for m in self.special_pattern.finditer(text)] if self.special_pattern else []
        parts, at, total = [np.zeros(1, np.int32)], 0, 0
        for start, end in [*marks, (len(text), len(text))]:
            if start > at:
                parts.append(self.plain_prefixes(text[at:start]) + total)
                total = int(parts[-1][-1])
            if end > start:
                parts.append(self._inside_special(text[at:start], text[start:end], total))
                total += 1
                at = end
        return np.concatenate(parts)

    def _inside_special(self, before: str, special: str, total: int) -> np.ndarray:
        """Counts for the characters of a special token: all but the whole of it are plain text.

        They may join the last piece before them, so that piece is split again, with the white space after it.
        """
        pieces = self.pattern.findall(before)
        last = len(pieces)
        while last and pieces[last - 1].isspace():
            last -= 1
        tail = "".join(pieces[max(0, last - 1) :])
        base = total - self.total(tail)
        inside = [base + self.total(tail + special[:size]) for size in range(1, len(special))]
        return np.array([*inside, total + 1], np.int32)


def cut(prefixes: np.ndarray, budget: int) -> int:
    """The length of the longest prefix that has at most ``budget`` tokens."""
    return int(np.flatnonzero(prefixes <= max(0, budget))[-1])


def _of_worker(box: dict) -> Vocabulary:
    """The vocabulary, with what it has learnt, of this worker: a broadcast value outlives a task."""
    if "vocabulary" not in box:
        box["vocabulary"] = Vocabulary(box["json"])
    return box["vocabulary"]


def token_counts(text: Column, vocabulary_json: str, budget: int) -> Column:
    """A struct per text: ``n_tokens``, and ``cut``, how many characters fit ``budget`` tokens.

    Both are read from the table of all prefixes of the text. ``vocabulary_json`` is the content of the
    tokenizer file, which the driver reads, so executors need no path. Null and empty texts have 0 tokens;
    any text is counted whole.
    """
    from pyspark.sql import SparkSession

    shared = SparkSession.getActiveSession().sparkContext.broadcast({"json": vocabulary_json})

    @pandas_udf("n_tokens long, cut long")
    def counted(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        vocabulary = _of_worker(shared.value)
        for texts in batches:
            rows = []
            for text in texts:
                prefixes = vocabulary.prefixes(text)
                rows.append((int(prefixes[-1]), cut(prefixes, budget)))
            yield pd.DataFrame(rows, columns=["n_tokens", "cut"])

    return counted.asNondeterministic()(text)


def prefix_counts(text: Column, vocabulary_json: str) -> Column:
    """Per text an array with the tokens of every prefix: element i is for its first i characters.

    Questions of truncation and budget are answered from it in SQL, without the tokenizer.
    """
    from pyspark.sql import SparkSession

    shared = SparkSession.getActiveSession().sparkContext.broadcast({"json": vocabulary_json})

    @pandas_udf("array<int>")
    def tabled(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        vocabulary = _of_worker(shared.value)
        for texts in batches:
            yield pd.Series([vocabulary.prefixes(text) for text in texts])

    return tabled.asNondeterministic()(text)
