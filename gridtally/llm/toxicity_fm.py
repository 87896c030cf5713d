"""Toxicity by a factorization machine over hashed terms."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from gridtally.llm.common import bounded_sample

# The model is fitted on at most so many labelled documents, those with the smallest hashes of ids.
FIT_ROWS = 8_000
THRESHOLD = 0.5

BUCKETS = 1 << 18
# Buckets in fewer documents than this teach nothing and weigh nothing.
MIN_DOCUMENTS = 3
# With all buckets, fitting passes over its documents until it has seen about so many, 4 times at least.
VISITS = 32_000
FACTORS = 8
_MEMO = 400_000

_WORDS = re.compile(r"[^\W\d_]+")


def terms(word: str) -> tuple[int, ...]:
    """The buckets of one lower-case word: itself and, if it is long, its first four, five and six letters."""
    names = [word]
    names += [f"{word[:size]}-" for size in (4, 5, 6) if len(word) > size]
    return tuple(zlib.crc32(name.encode()) % BUCKETS for name in names)


def buckets(text: str | None) -> list[int]:
    """The distinct buckets of a text, ascending; none for null or empty ones."""
    found: set[int] = set()
    for word in set(_WORDS.findall(text.lower())) if text else ():
        found.update(terms(word))
    return sorted(found)


@dataclass(frozen=True)
class Machine:
    """``slots`` maps buckets to rows of the weights; other buckets do not count."""

    base: float
    slots: dict[int, int]
    weights: np.ndarray
    factors: np.ndarray

    def logit(self, chosen: list[int]) -> float:
        if not chosen:
            return self.base
        vectors = self.factors[chosen]
        added = vectors.sum(0)
        return float(
            self.base + self.weights[chosen].sum() + 0.5 * ((added * added).sum() - (vectors * vectors).sum())
        )


def fit(
    rows: list[np.ndarray],
    labels: np.ndarray,
    epochs: int = 30,
    epochs_of_all: int | None = None,
    rate: float = 0.2,
    decay: float = 1e-5,
    rare_weight: float = 6.0,
    shrinkage: float = 0.01,
    caution: tuple[float, float] = (100.0, 0.3),
    seed: int = 7,
) -> Machine:
    """Learn weights and pair factors of all buckets that ``MIN_DOCUMENTS`` documents have, by AdaGrad.

    No bucket is left out for telling little by itself: it may tell together with another. But a bucket whose
    share of documents differs by at most two deviations between the labels is learnt with ``caution`` (the
    squared gradients AdaGrad starts from, for its weight and for its factors), and decays by ``shrinkage``
    instead of ``decay``, so that noise fades while a joint effect that many documents show grows. These are
    joined by the others after ``epochs`` passes without them, which are quick. A batch
    changes the buckets of its own documents only. A document of
    label 1 weighs as ``rare_weight`` others, or as many as balance the labels if that is less. Without rows
    every score is 0.5; with one label only, the smoothed share of ones.
    """
    positive = float(labels.sum())
    negative = len(labels) - positive
    base = float(np.log((positive + 1) / (negative + 1)))
    empty = Machine(base, {}, np.zeros(0), np.zeros((0, FACTORS)))
    if not positive or not negative:
        return empty
    weight_of = np.where(labels == 1, max(1.0, min(rare_weight, negative / positive)), 1.0)
    documents = np.bincount(np.concatenate([*rows, np.zeros(0, np.int64)]).astype(np.int64), minlength=BUCKETS)
    active = np.flatnonzero(documents >= MIN_DOCUMENTS)
    slot_of = np.full(BUCKETS, -1)
    slot_of[active] = np.arange(len(active))
    known = [slot_of[row] for row in rows]
    known = [own[own >= 0].astype(np.int32) for own in known]

    rng = np.random.default_rng(seed)
    w, v = np.zeros(len(active)), rng.normal(0, 0.01, (len(active), FACTORS))
    telling = _telling(known, labels, len(active)) > 2
    shrink = np.where(telling, decay, shrinkage)
    gw = np.where(telling, 1e-6, caution[0])
    gv = np.repeat(np.where(telling, 1e-6, caution[1])[:, None], FACTORS, axis=1)
    g0 = 1e-6
    told = [own[telling[own]] for own in known]
    passes = epochs_of_all or min(epochs, max(4, VISITS // len(rows)))
    for read in [told] * epochs + [known] * passes:
        shuffled = rng.permutation(len(rows))
        for start in range(0, len(rows), 128):
            batch = shuffled[start : start + 128]
            at = np.concatenate([read[i] for i in batch])
            if not len(at):
                continue
            doc = np.repeat(np.arange(len(batch)), [len(read[i]) for i in batch])
            vectors = v[at]
            added = np.zeros((len(batch), FACTORS))
            firsts = np.flatnonzero(np.append(True, doc[1:] != doc[:-1]))
            added[doc[firsts]] = np.add.reduceat(vectors, firsts)
            squares = np.bincount(doc, weights=(vectors * vectors).sum(1), minlength=len(batch))
            logits = base + np.bincount(doc, weights=w[at], minlength=len(batch))
            logits += 0.5 * ((added * added).sum(1) - squares)
            slope = 1 / (1 + np.exp(-np.clip(logits, -30, 30))) - labels[batch]
            slope *= weight_of[batch]
            order = np.argsort(at, kind="stable")
            at, doc, vectors = at[order], doc[order], vectors[order]
            heads = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
            met = at[heads]
            push = slope[doc]
            dw = np.add.reduceat(push, heads) / len(batch) + shrink[met] * w[met]
            dv = np.add.reduceat(push[:, None] * (added[doc] - vectors), heads)
            dv = np.clip(dv / len(batch) + shrink[met, None] * v[met], -1, 1)
            d0 = slope.mean()
            gw[met] += dw * dw
            gv[met] += dv * dv
            g0 += d0 * d0
            w[met] -= rate * dw / np.sqrt(gw[met])
            v[met] -= 0.2 * rate * dv / np.sqrt(gv[met])
            base -= rate * d0 / np.sqrt(g0)
    return Machine(float(base), {int(b): i for i, b in enumerate(active)}, w, v)


def _telling(known: list[np.ndarray], labels: np.ndarray, size: int) -> np.ndarray:
    """By how many standard deviations the shares of the two labels' documents that have a bucket differ."""
    none = [np.zeros(0, np.int32)]
    ones, zeros = (
        np.bincount(np.concatenate(none + [own for own, y in zip(known, labels) if y == label]), minlength=size)
        for label in (1, 0)
    )
    positive = labels.sum()
    negative = len(labels) - positive
    share = (ones + zeros) / len(labels)
    spread = np.sqrt((share * (1 - share) + 1e-9) * (1 / positive + 1 / negative))
    return np.abs(ones / positive - zeros / negative) / spread


def fit_on(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> Machine:
    """The machine of ``labels`` (``doc_id``, ``label`` 0 or 1) on the texts of ``docs``.

    Only the buckets of at most ``rows`` documents reach the driver, at most ``BUCKETS`` each; a
    repeated id counts with its smallest label. Null labels and labels of unknown ids teach nothing.
    """

    @pandas_udf("binary")
    def hashed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([np.array(buckets(text), dtype="<i4").tobytes() for text in texts])

    sample = bounded_sample(
        labels.where("label is not null and doc_id is not null"), docs.select("doc_id", "text"), rows
    )
    learned = (
        sample.select("doc_id", "label", hashed.asNondeterministic()("text").alias("x"))
        .orderBy(F.xxhash64("doc_id"), "doc_id", "x")
        .limit(rows)
        .toPandas()
    )
    x = [np.frombuffer(row, dtype="<i4") for row in learned["x"]]
    return fit(x, learned["label"].to_numpy(dtype=float))


def score(text: Column, machine: Machine) -> Column:
    """A score from 0 to 1 for each text, higher where label 1 is likelier; null and empty texts have one too.

    It is the probability of label 1 if that were as frequent as the weights in ``fit`` make it.
    """

    @pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        slots = machine.slots
        memo: dict[str, tuple[int, ...]] = {}
        for texts in batches:
            logits = []
            for text in texts:
                chosen: set[int] = set()
                for word in set(_WORDS.findall(text.lower())) if text else ():
                    own = memo.get(word)
                    if own is None:
                        if len(memo) >= _MEMO:
                            memo.clear()
                        own = tuple(slots[b] for b in terms(word) if b in slots)
                        memo[word] = own
                    if own:
                        chosen.update(own)
                logits.append(machine.logit(sorted(chosen)))
            yield pd.Series(1 / (1 + np.exp(-np.clip(np.array(logits, dtype=float), -30, 30))))

    return scored.asNondeterministic()(text)
