"""Text quality by a generalised additive model with pairwise interactions.

Numbers that describe a text are binned; each has a table with a value per bin, and
some pairs have a table per pair of bins. The tables grow by cyclic boosting: in
turn, a shallow tree on one number (later, one pair) is fitted to what the others
leave, and a small share of it is added to that table. A score is the sum of the
table entries of a text's bins, through the logistic function.
"""

from __future__ import annotations

import itertools
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txlake.llm.common import slices, texts
from txlake.llm.labelled import fold, training_rows

MAX_TRAINING_ROWS = 20_000
FOLDS, HELD_OUT, THRESHOLD = 4, 2, 0.7
BINS = 32
ROUNDS, PAIR_ROUNDS, PAIRS = 120, 60, 6
RATE = 0.15
LEAST_WEIGHT = 2.0

_UPPER, _LOWER, _DIGIT = bytes(range(65, 91)), bytes(range(97, 123)), bytes(range(48, 58))
_MARKS = bytes(b for b in range(33, 127) if not chr(b).isalnum())
_RUNS = re.compile(rb"[!-/:-@\[-`{-~]{2,}")

NUMBERS = (
    "log_chars", "log_words", "word_length", "upper", "digits", "marks", "mark_runs", "bars", "exclaims", "stops",
    "distinct_words", "top_word", "words_per_line", "repeated_lines", "beyond_ascii", "no_final_stop",
)


def describe(text: str) -> tuple[float, ...]:
    """The numbers of one whole text; all of an empty one are 0."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    if not words:
        return (0.0,) * len(NUMBERS)
    n, size = len(words), len(raw)

    def share(of: bytes) -> float:
        return 1 - len(raw.translate(None, of)) / size

    upper, lower = share(_UPPER), share(_LOWER)
    counts = Counter(words)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    return (
        float(np.log1p(len(text))),
        float(np.log1p(n)),
        (size - raw.count(b" ") - raw.count(b"\n")) / n,
        upper / (upper + lower) if upper + lower else 0.0,
        share(_DIGIT),
        share(_MARKS),
        len(_RUNS.findall(raw)) / n,
        raw.count(b"|") / n,
        raw.count(b"!") / n,
        raw.count(b".") / n,
        len(counts) / n**0.85,  # falls with length in any prose
        max(counts.values()) / n,
        n / len(lines),
        1 - len(set(lines)) / len(lines),
        1 - len(text) / size,
        float(words[-1][-1:] not in b".!?"),
    )


@dataclass
class Model:
    """Edges and table for each number, tables of pairs, and the constant."""

    edges: list[np.ndarray]
    tables: list[np.ndarray]
    pairs: dict[tuple[int, int], np.ndarray]
    bias: float

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], "right") for j, e in enumerate(self.edges)], axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        b = self.bins(x)
        z = np.full(len(x), self.bias)
        for j, t in enumerate(self.tables):
            z += t[b[:, j]]
        for (i, j), t in self.pairs.items():
            z += t[b[:, i], b[:, j]]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return np.where(h > LEAST_WEIGHT, g * g / np.maximum(h, LEAST_WEIGHT), 0)


def _leaf(g: np.ndarray, h: np.ndarray) -> float:
    return float(g.sum() / (h.sum() + LEAST_WEIGHT))


def line_tree(g: np.ndarray, h: np.ndarray, leaves: int = 3) -> np.ndarray:
    """A tree of few leaves over bins in order, as the leaf value of every bin."""
    cuts = [0, len(g)]
    for _ in range(leaves - 1):
        best, at = 1e-12, None
        for a, b in itertools.pairwise(cuts):
            if b - a < 2:
                continue
            left_g, left_h = np.cumsum(g[a:b])[:-1], np.cumsum(h[a:b])[:-1]
            right_g, right_h = g[a:b].sum() - left_g, h[a:b].sum() - left_h
            fair = (left_h > LEAST_WEIGHT) & (right_h > LEAST_WEIGHT)
            rise = np.where(fair, _gain(left_g, left_h) + _gain(right_g, right_h) - _gain(g[a:b].sum(), h[a:b].sum()), 0)
            if rise.max() > best:
                best, at = float(rise.max()), a + 1 + int(rise.argmax())
        if at is None:
            break
        cuts = sorted([*cuts, at])
    values = np.zeros(len(g))
    for a, b in itertools.pairwise(cuts):
        values[a:b] = _leaf(g[a:b], h[a:b])
    return values


def grid_tree(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """The best cut of a grid into four by one place on each axis: its gain, and the leaf value of every cell."""

    def corners(x: np.ndarray) -> list[np.ndarray]:
        c = x.cumsum(0).cumsum(1)
        a, row, col, total = c[:-1, :-1], c[:-1, -1:], c[-1:, :-1], c[-1, -1]
        return [a, row - a, col - a, total - row - col + a]

    if min(g.shape) < 2:
        return 0.0, np.zeros_like(g)
    rise = sum(_gain(a, b) for a, b in zip(corners(g), corners(h), strict=True))
    i, j = np.unravel_index(int(rise.argmax()), rise.shape)
    values = np.zeros_like(g)
    for rows in (slice(0, i + 1), slice(i + 1, None)):
        for cols in (slice(0, j + 1), slice(j + 1, None)):
            values[rows, cols] = _leaf(g[rows, cols], h[rows, cols])
    return float(rise[i, j]), values


def fit_tables(x: np.ndarray, y: np.ndarray) -> Model:
    """Cyclic boosting; without both classes every score is the smoothed rate."""
    bias = float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
    width = x.shape[1]
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) if len(x) else np.zeros(0) for j in range(width)]
    model = Model(edges, [np.zeros(len(e) + 1) for e in edges], {}, bias)
    if len(np.unique(y)) < 2:
        return model
    b = model.bins(x)
    z = np.full(len(y), bias)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-z))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for j, t in enumerate(model.tables):
            g, h = slopes()
            step = RATE * line_tree(np.bincount(b[:, j], g, len(t)), np.bincount(b[:, j], h, len(t)))
            t += step
            z += step[b[:, j]]

    shape = [len(t) for t in model.tables]
    cell = {(i, j): b[:, i] * shape[j] + b[:, j] for i, j in itertools.combinations(range(width), 2)}

    def grid(i: int, j: int, v: np.ndarray) -> np.ndarray:
        return np.bincount(cell[i, j], v, shape[i] * shape[j]).reshape(shape[i], shape[j])

    g, h = slopes()
    ranked = sorted(cell, key=lambda p: (-grid_tree(grid(*p, g), grid(*p, h))[0], p))
    model.pairs = {p: np.zeros((shape[p[0]], shape[p[1]])) for p in ranked[:PAIRS]}
    for _ in range(PAIR_ROUNDS):
        for (i, j), t in model.pairs.items():
            g, h = slopes()
            step = RATE * grid_tree(grid(i, j, g), grid(i, j, h))[1]
            t += step
            z += step[b[:, i], b[:, j]]
    return model


def fit(rows: DataFrame) -> Model:
    """Fit on ``text, y``: the executors describe the texts, only the numbers come to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [describe(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("y"), pa.array(found, pa.list_(pa.float64()))], names=["y", "x"])

    found = rows.mapInArrow(run, "y int, x array<double>").toPandas()  # bounded by training_rows
    data = sorted((y, *x) for y, x in found.itertuples(index=False))  # a fixed order, so that sums come out alike
    table = np.array(data, float).reshape(len(data), 1 + len(NUMBERS))
    return fit_tables(table[:, 1:], (table[:, 0] > 0).astype(float))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score`` for every row, from the whole text alone; null texts are empty, repeated rows and null ids are kept."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            x = np.array([describe(t) for t in batch.column("text").to_pylist()], float).reshape(-1, len(NUMBERS))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(model.score(x))], names=["doc_id", "score"])

    return texts(docs).mapInArrow(run, "doc_id long, score double")


def classify(docs: DataFrame, labels: DataFrame, most: int = MAX_TRAINING_ROWS) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``.

    Fitted on at most ``most`` labelled rows outside the held-out fold (see
    ``training_rows`` for nulls and repeats). Without labels of both classes the
    score is the same for all. Empty tables give no rows; other columns of either
    table are ignored.
    """
    model = fit(training_rows(docs, labels, "quality", FOLDS, HELD_OUT, most))
    return score(docs, model).select(
        "doc_id",
        (fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def keep_good(docs: DataFrame, labels: DataFrame, most: int = MAX_TRAINING_ROWS) -> DataFrame:
    """The rows of ``docs`` that score ``THRESHOLD`` or more, with all their columns and without a shuffle."""
    model = fit(training_rows(docs, labels, "quality", FOLDS, HELD_OUT, most))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            whole = [t or "" for t in batch.column("text").to_pylist()]
            x = np.array([describe(t) for t in whole], float).reshape(-1, len(NUMBERS))
            yield batch.filter(pa.array(model.score(x) >= THRESHOLD))

    return docs.mapInArrow(run, docs.schema)
