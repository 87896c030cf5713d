"""Training examples from conversations: every assistant turn with all turns before it as its context.

A conversation is written turn by turn in one template, so the text of an example is a prefix of the text
of the conversation. Its loss mask covers the last reply alone. Control strings of the template inside texts
are escaped by a mark after their bracket, ``</s>`` becoming ``<~/s>``, and one mark more is added where marks
stand already, so that reading takes off exactly what writing put on.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# About so many characters are handed on at once.
_BATCH_CHARACTERS = 1 << 21

USER, ASSISTANT = "user", "assistant"
_ESCAPABLE = re.compile(r"(?:<(?=~*/?s>)|\[(?=~*/?(?:INST|ROLE)\]))")
_ESCAPED = re.compile(r"(<(?=~+/?s>)|\[(?=~+/?(?:INST|ROLE)\]))~")
_TURN = re.compile(
    r"<s>\[INST\](?P<user>.*?)\[/INST\]|\[ROLE\](?P<role>.*?)\[/ROLE\](?P<text>.*?)</s>|(?P<reply>.*?)</s>", re.S
)

EXAMPLE = "example long, start long, text string, loss_start long, loss_end long"
_READ = "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, n_examples long, formatted_chars long"


def escape(text: str) -> str:
    """``text`` without control strings; ``unescape`` gives it back."""
    return _ESCAPABLE.sub(r"\g<0>~", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def format_turn(role: str, text: str) -> tuple[str, int, int]:
    """The turn in the template, and where in it the escaped text begins and ends."""
    body = escape(text)
    if role == USER:
        before, after = "<s>[INST]", "[/INST]"
    elif role == ASSISTANT:
        before, after = "", "</s>"
    else:
        before, after = f"[ROLE]{escape(role)}[/ROLE]", "</s>"
    return before + body + after, len(before), len(before) + len(body)


def read_turns(text: str) -> Iterator[tuple[str, str]]:
    """Role and text of the turns that ``text`` was formatted from."""
    for found in _TURN.finditer(text):
        if found["user"] is not None:
            yield USER, unescape(found["user"])
        elif found["role"] is not None:
            yield unescape(found["role"]), unescape(found["text"])
        else:
            yield ASSISTANT, unescape(found["reply"])


def expand(turns: DataFrame, whole_characters: int | None = None) -> DataFrame:
    """``conv_id``, ``example`` (from 1), ``start``, ``text``, ``loss_start``, ``loss_end`` of every example.

    ``turns`` has ``conv_id``, ``turn``, ``role`` and ``text``. Turns follow each other by ``turn``, then
    role, then text, nulls first, and repeated rows are turns of their own. Null roles and texts are empty,
    rows without ``conv_id`` are one conversation. An example ends with an assistant turn; what follows the
    last one is an example with an empty mask, so that no turn is lost. The mask counts code points from the
    beginning of the conversation.

    ``text`` is the whole example and ``start`` 0, however long the conversation is, so the characters written grow
    with its number of replies times its length. A caller who cannot hold that may ask for parts: with
    ``whole_characters``, in a longer conversation ``text`` begins where the row before ended, at ``start``, so that rows do not grow
    with their number and a task holds little more than ``whole_characters`` and one turn; turns of that size
    without any reply are rows without a mask. The rows of a conversation stand in one partition, in order.
    """
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce("text", F.lit(""))
    rows = turns.select("conv_id", "turn", role.alias("role"), text.alias("text"))
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    key = turns.schema["conv_id"].dataType.simpleString()

    def examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Rows(["conv_id", *_names(EXAMPLE)])
        state = _Conversation(whole_characters)
        current: object = out  # no conversation is called that
        for batch in batches:
            out.like(batch, "conv_id")
            for conv, role, text in zip(*(batch.column(n).to_pylist() for n in ("conv_id", "role", "text"))):
                if conv != current:
                    for row in state.rest():
                        out.add(current, *row)
                    state, current = _Conversation(whole_characters), conv
                for row in state.turn(role, text):
                    out.add(current, *row)
                if out.full():
                    yield out.batch()
        for row in state.rest():
            out.add(current, *row)
        if out.rows:
            yield out.batch()

    return ordered.mapInArrow(examples, f"conv_id {key}, {EXAMPLE}")


def read_back(examples: DataFrame, in_order: bool = False) -> DataFrame:
    """Per conversation what its ``examples`` say: turns, all text under the mask, and sizes.

    ``turns_sha256`` is of role, line feed, text, line feed of each turn, ``loss_sha256`` of the unescaped
    texts under the masks, ``formatted_chars`` the code points of all examples, contexts included. Rows from
    ``expand`` itself are ``in_order``; others, as from files, are shuffled and sorted first. Digests are
    taken row by row, so a task holds one row of a conversation.
    """
    if not in_order:
        examples = examples.repartition("conv_id").sortWithinPartitions("conv_id", "example")
    key = examples.schema["conv_id"].dataType.simpleString()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Rows(["conv_id", *_names(_READ)])
        state, current = _Reading(), out
        for batch in batches:
            out.like(batch, "conv_id")
            columns = (batch.column(n).to_pylist() for n in ("conv_id", "start", "text", "loss_start", "loss_end"))
            for conv, *row in zip(*columns):
                if conv != current:
                    if current is not out:
                        out.add(current, *state.result())
                    state, current = _Reading(), conv
                state.add(*row)
            if out.full():
                yield out.batch()
        if current is not out:
            out.add(current, *state.result())
        if out.rows:
            yield out.batch()

    return examples.mapInArrow(read, f"conv_id {key}, {_READ}")


class _Conversation:
    """The formatted text of a conversation so far, and the examples in it."""

    def __init__(self, whole_characters: int | None):
        self.limit = math.inf if whole_characters is None else whole_characters
        self.pieces: list[str] = []  # the text from ``start`` on
        self.start = self.end = self.number = 0
        self.open = False  # whether turns follow the last row

    def turn(self, role: str, text: str) -> Iterator[tuple]:
        piece, low, high = format_turn(role, text)
        if self.end + len(piece) > self.limit and self.open and self.end - self.start > self.limit:
            yield self._row(None, None)
        low, high = self.end + low, self.end + high
        self.pieces.append(piece)
        self.end += len(piece)
        self.open = True
        if role == ASSISTANT:
            yield self._row(low, high)

    def rest(self) -> Iterator[tuple]:
        if self.open:
            yield self._row(self.end, self.end)

    def _row(self, low: int | None, high: int | None) -> tuple:
        self.number += 1
        text = "".join(self.pieces)
        row = (self.number, self.start, text, low, high)
        self.pieces = [text]
        self.open = False
        if self.end > self.limit:
            self.pieces, self.start = [], self.end
        return row


class _Reading:
    """Digests of the examples of a conversation, one after the other."""

    def __init__(self) -> None:
        self.turns, self.loss = sha256(), sha256()
        self.n_turns = self.loss_chars = self.n_examples = self.formatted = self.end = 0

    def add(self, start: int, text: str, low: int | None, high: int | None) -> None:
        for role, said in read_turns(text[self.end - start :]):
            self.turns.update(f"{role}\n{said}\n".encode())
            self.n_turns += 1
        self.end = start + len(text)
        if low is not None:
            reply = unescape(text[low - start : high - start])
            self.loss.update(reply.encode())
            self.loss_chars += len(reply)
            self.n_examples += 1
            self.formatted += self.end

    def result(self) -> tuple:
        return (
            self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.n_examples, self.formatted,
        )


class _Rows:
    """Rows gathered into Arrow batches."""

    def __init__(self, names: list[str]):
        self.names, self.rows, self.characters, self.key = names, [], 0, pa.int64()

    def like(self, batch: pa.RecordBatch, name: str) -> None:
        self.key = batch.schema.field(name).type

    def add(self, *row: object) -> None:
        self.rows.append(row)
        self.characters += 64 + sum(len(value) for value in row if isinstance(value, str))

    def full(self) -> bool:
        return self.characters > _BATCH_CHARACTERS

    def batch(self) -> pa.RecordBatch:
        first, *others = zip(*self.rows)
        arrays = [pa.array(first, self.key)]
        for values in others:
            text = any(isinstance(value, str) for value in values)
            arrays.append(pa.array(values, pa.string() if text else pa.int64()))
        self.rows, self.characters = [], 0
        return pa.RecordBatch.from_arrays(arrays, names=self.names)


def _names(ddl: str) -> list[str]:
    return [column.split()[0] for column in ddl.split(", ")]
