"""Text quality by a generalised additive model with pairwise interactions."""

from __future__ import annotations

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
FIT_ROWS = 20_000
THRESHOLD = 0.7

FEATURES = (
    "log_bytes",
    "upper_share",
    "digit_share",
    "symbol_share",
    "stop_share",
    "comma_share",
    "space_share",
    "line_share",
    "foreign_share",
    "word_bytes",
    "distinct_words",
    "distinct_lines",
    "compressed_share",
    "log_words",
)

_SYMBOLS = [i for i in range(33, 127) if not chr(i).isalnum() and chr(i) not in ".,'\"-"]


def features(text: str | None) -> list[float]:
    """The numbers a score depends on; an empty or null text has zeros only."""
    raw = text.encode() if text else b""
    if not raw:
        return [0.0] * len(FEATURES)
    size = len(raw)
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    upper, lower = counts[65:91].sum(), counts[97:123].sum()
    words = raw.split()
    lines = raw.split(b"\n")
    return [
        float(np.log1p(size)),
        upper / max(upper + lower, 1),
        counts[48:58].sum() / size,
        counts[_SYMBOLS].sum() / size,
        counts[46] / size,
        counts[44] / size,
        counts[32] / size,
        counts[10] / size,
        counts[128:].sum() / size,
        (size - counts[32] - counts[10]) / max(len(words), 1),
        len(set(words)) / max(len(words), 1),
        len(set(lines)) / len(lines),
        len(zlib.compress(raw, 1)) / size,
        float(np.log1p(len(words))),
    ]


@dataclass(frozen=True)
class Gam:
    """Lookup tables: one per feature, and one per interacting pair of features."""

    base: float
    edges: list[np.ndarray]
    shapes: list[np.ndarray]
    pair_edges: list[np.ndarray]
    pairs: list[tuple[int, int, np.ndarray]]

    def scores(self, rows: np.ndarray) -> np.ndarray:
        """Probabilities of the rows, by adding the entries of the bins they fall in."""
        total = np.full(len(rows), self.base)
        for column, (edges, shape) in enumerate(zip(self.edges, self.shapes)):
            total += shape[np.searchsorted(edges, rows[:, column], side="right")]
        coarse = {}
        for i, j, grid in self.pairs:
            for column in (i, j):
                if column not in coarse:
                    coarse[column] = np.searchsorted(self.pair_edges[column], rows[:, column], side="right")
            total += grid[coarse[i], coarse[j]]
        return 1 / (1 + np.exp(-total))


def fit(
    rows: np.ndarray,
    labels: np.ndarray,
    bins: int = 32,
    pair_bins: int = 8,
    rounds: int = 120,
    pair_rounds: int = 40,
    pairs: int = 6,
    rate: float = 0.1,
) -> Gam:
    """Boost one shallow tree per feature in turn, then one per pair on what the features leave.

    The pairs are those whose first tree lowers the loss most. Without rows every score is 0.5.
    """
    width = rows.shape[1] if rows.size else len(FEATURES)
    positive = float(labels.sum())
    base = float(np.log((positive + 1) / (len(labels) - positive + 1)))
    edges = [_edges(rows[:, i], bins) if len(labels) else np.zeros(0) for i in range(width)]
    shapes = [np.zeros(len(e) + 1) for e in edges]
    pair_edges = [_edges(rows[:, i], pair_bins) if len(labels) else np.zeros(0) for i in range(width)]
    model = Gam(base, edges, shapes, pair_edges, [])
    if positive in (0.0, float(len(labels))):
        return model
    fine = [np.searchsorted(e, rows[:, i], side="right") for i, e in enumerate(edges)]
    coarse = [np.searchsorted(e, rows[:, i], side="right") for i, e in enumerate(pair_edges)]
    total = np.full(len(labels), base)
    for _ in range(rounds):
        for i in range(width):
            slope, weight = _gradients(total, labels, fine[i], len(shapes[i]))
            step = rate * _tree(slope, weight)
            shapes[i] += step
            total += step[fine[i]]
    ranked = []
    for i in range(width):
        for j in range(i + 1, width):
            size = (len(pair_edges[i]) + 1, len(pair_edges[j]) + 1)
            slope, weight = _gradients(total, labels, coarse[i] * size[1] + coarse[j], size[0] * size[1])
            _, gain = _tree_of_pair(slope.reshape(size), weight.reshape(size))
            ranked.append((-gain, i, j))
    chosen = [(i, j) for _, i, j in sorted(ranked)[:pairs]]
    grids = [np.zeros((len(pair_edges[i]) + 1, len(pair_edges[j]) + 1)) for i, j in chosen]
    for _ in range(pair_rounds):
        for (i, j), grid in zip(chosen, grids):
            cell = coarse[i] * grid.shape[1] + coarse[j]
            slope, weight = _gradients(total, labels, cell, grid.size)
            step = rate * _tree_of_pair(slope.reshape(grid.shape), weight.reshape(grid.shape))[0]
            grid += step
            total += step[coarse[i], coarse[j]]
    return Gam(base, edges, shapes, pair_edges, [(i, j, g) for (i, j), g in zip(chosen, grids)])


def _edges(values: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.arange(1, bins) / bins))


def _gradients(total: np.ndarray, labels: np.ndarray, bin_of: np.ndarray, bins: int):
    p = 1 / (1 + np.exp(-total))
    slope = np.bincount(bin_of, weights=labels - p, minlength=bins)
    return slope, np.bincount(bin_of, weights=p * (1 - p), minlength=bins)


_SMOOTH = 5.0


def _gain(slope, weight):
    return slope * slope / (weight + _SMOOTH)


def _best_cut(slope: np.ndarray, weight: np.ndarray) -> tuple[int, float]:
    """The position that splits the bins best, and what the split gains."""
    if len(slope) < 2:
        return 0, 0.0
    left, heavy = np.cumsum(slope)[:-1], np.cumsum(weight)[:-1]
    both, all_weight = slope.sum(), weight.sum()
    gains = _gain(left, heavy) + _gain(both - left, all_weight - heavy) - _gain(both, all_weight)
    at = int(np.argmax(gains))
    return at + 1, float(gains[at])


def _tree(slope: np.ndarray, weight: np.ndarray, depth: int = 2) -> np.ndarray:
    """The step of each bin: a tree of at most 2 ** depth leaves along one feature."""
    at, gain = _best_cut(slope, weight) if depth else (0, 0.0)
    if gain <= 1e-9:
        return np.full(len(slope), slope.sum() / (weight.sum() + _SMOOTH))
    return np.concatenate(
        [_tree(slope[:at], weight[:at], depth - 1), _tree(slope[at:], weight[at:], depth - 1)]
    )


def _tree_of_pair(slope: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, float]:
    """The step of each cell: one cut along a feature, then one along the other on either side."""
    best = (np.zeros_like(slope), 0.0)
    for turned in (False, True):
        s, w = (slope.T, weight.T) if turned else (slope, weight)
        at, _ = _best_cut(s.sum(1), w.sum(1))
        step, gained = np.zeros_like(s), -_gain(s.sum(), w.sum())
        for half in (slice(0, at), slice(at, None)):
            part, heavy = s[half].sum(0), w[half].sum(0)
            step[half] = _tree(part, heavy, 1)
            cut, _ = _best_cut(part, heavy)
            gained += sum(
                _gain(part[side].sum(), heavy[side].sum()) for side in (slice(0, cut), slice(cut, None))
            )
        if gained > best[1]:
            best = (step.T if turned else step, float(gained))
    return best


def fit_on(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> Gam:
    """The model of ``labels`` (``doc_id``, ``label`` 0 or 1) on the texts of ``docs``.

    Only the features of at most ``rows`` documents reach the driver; a repeated id counts with its
    smallest label. Null labels, and labels of unknown ids, teach nothing.
    """
    sample = bounded_sample(labels.where("label is not null and doc_id is not null"), docs.select("doc_id", "text"), rows)
    learned = (
        sample.select("doc_id", "label", features_of(F.col("text")).alias("x"))
        .orderBy(F.xxhash64("doc_id"), "doc_id", "x")
        .limit(rows)
        .toPandas()
    )
    x = np.array(learned["x"].tolist(), dtype=float).reshape(len(learned), len(FEATURES))
    return fit(x, learned["label"].to_numpy(dtype=float))


def features_of(text: Column) -> Column:
    """The features of each text as an array of doubles."""

    @pandas_udf("array<double>")
    def extract(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([features(text) for text in texts])

    return extract.asNondeterministic()(text)


def score(text: Column, model: Gam) -> Column:
    """The probability of label 1 for each text; null and empty texts have one too."""

    @pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            rows = np.array([features(text) for text in texts], dtype=float)
            yield pd.Series(model.scores(rows.reshape(len(texts), len(FEATURES))))

    return scored.asNondeterministic()(text)


def keep_good(docs: DataFrame, model: Gam, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` whose text scores at least ``threshold``."""
    name = "_score"
    while name in docs.columns:
        name += "_"
    return docs.withColumn(name, score(F.col("text"), model)).where(F.col(name) >= threshold).drop(name)
