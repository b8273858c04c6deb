"""Toxicity by a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

A text is the set of its hashed n-grams, across word ends. Every n-gram has the
ratio r of its smoothed document frequencies among toxic and other training texts,
as a logarithm; those whose ratio is surest are the features, with r as their value
where the text holds them. A logistic regression with an L2 penalty is fitted on
these values and scores every whole text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txlake.llm.common import slices, texts
from txlake.llm.labelled import fold, training_rows

SIZES = (3, 4, 5, 6)
HASH_BITS = 18
FEATURES = 2048
MAX_TRAINING_ROWS = 20_000
FOLDS, HELD_OUT, THRESHOLD = 5, 0, 0.5
SMOOTHING = 1.0
PENALTY = 1e-4
STEPS = 200
#: Code points hashed at once.
BLOCK = 1 << 16

_SPREAD, _FINAL = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def ngrams(text: str) -> Iterator[np.ndarray]:
    """Bucket numbers of all n-grams of a text, block by block, repeats included; the empty text has none."""
    line = " ".join(text.lower().split())
    if not line:
        return
    points = np.frombuffer(f" {line} ".encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    for begin in range(0, len(points), BLOCK):
        part = points[begin : begin + BLOCK + SIZES[-1] - 1]
        h = np.zeros(len(part), np.uint64)
        for n in range(1, SIZES[-1] + 1):
            if n > len(part):
                break
            h = (h[: len(part) - n + 1] * _SPREAD) + part[n - 1 :]
            if n in SIZES:
                mixed = (h ^ (h >> np.uint64(29))) * _FINAL + np.uint64(n)
                yield (mixed[:BLOCK] >> np.uint64(64 - HASH_BITS)).astype(np.int64)


def present(text: str, number: np.ndarray) -> np.ndarray:
    """Whether a text holds each feature; ``number`` has each bucket's feature, or -1."""
    held = np.zeros(int(number.max(initial=-1)) + 1, bool)
    for buckets in ngrams(text):
        found = number[buckets]
        held[found[found >= 0]] = True
    return held


@dataclass
class Model:
    number: np.ndarray
    weight: np.ndarray
    bias: float

    def score(self, text: str) -> float:
        z = self.bias + float(self.weight[present(text, self.number)].sum())
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def document_frequencies(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Texts of each class that hold each bucket, and texts of each class."""
    size = 1 << HASH_BITS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, size + 1), np.int64)
        for batch in slices(batches):
            for text, y in zip(batch.column("text").to_pylist(), batch.column("y").to_pylist(), strict=True):
                held = np.zeros(size, bool)
                for buckets in ngrams(text):
                    held[buckets] = True
                counts[int(y > 0), :size] += held
                counts[int(y > 0), size] += 1
        bucket = np.flatnonzero(counts.any(axis=0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(bucket), pa.array(counts[0, bucket]), pa.array(counts[1, bucket])], names=["bucket", "clean", "toxic"]
        )

    summed = rows.mapInArrow(run, "bucket long, clean long, toxic long").groupBy("bucket").agg(
        F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")
    )
    counts = np.zeros((2, size + 1))
    found = summed.toPandas()  # a row for each bucket at most
    counts[:, found["bucket"]] = found[["clean", "toxic"]].to_numpy().T
    return counts[:, :size], counts[:, size]


def fit(rows: DataFrame, features: int = FEATURES) -> Model:
    """Fit on ``text, y``; without rows of both classes every score is the smoothed rate."""
    held, total = document_frequencies(rows)
    number = np.full(1 << HASH_BITS, -1, np.int64)
    prior = float(np.log((total[1] + 1) / (total[0] + 1)))
    if not total.all():
        return Model(number, np.zeros(0), prior)
    share = (held + SMOOTHING) / (total[:, None] + 2 * SMOOTHING)
    ratio = np.log(share[1] / share[0])
    spread = np.sqrt((1 - share[1]) / (held[1] + SMOOTHING) + (1 - share[0]) / (held[0] + SMOOTHING))
    sure = np.where(held.sum(axis=0) > 1, np.abs(ratio) / np.maximum(spread, 1e-9), 0)
    chosen = np.sort(np.argsort(-sure, kind="stable")[:features])
    chosen = chosen[sure[chosen] > 0]
    number[chosen] = np.arange(len(chosen))
    r = ratio[chosen]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [np.packbits(present(t, number)).tobytes() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("y"), pa.array(found, pa.binary())], names=["y", "held"])

    # a bit per feature: at most MAX_TRAINING_ROWS * FEATURES / 8 bytes; in a fixed order, so that sums come out alike
    data = sorted((y, bytes(held)) for y, held in rows.mapInArrow(run, "y int, held binary").toPandas().itertuples(index=False))
    packed = np.frombuffer(b"".join(held for _, held in data), np.uint8).reshape(len(data), -1)
    x = np.unpackbits(packed, axis=1, count=len(chosen)).astype(np.float32)
    w, bias = _logistic(x, r.astype(np.float32), np.array([y > 0 for y, _ in data], np.float32), prior)
    return Model(number, w * r, bias)


def _logistic(x: np.ndarray, r: np.ndarray, y: np.ndarray, bias: float) -> tuple[np.ndarray, float]:
    """Weights of the columns ``x * r`` by accelerated gradient descent, each scaled by its curvature's bound."""
    n, width = x.shape
    w, before = np.zeros(width, np.float32), np.zeros(width, np.float32)
    b, b_before = bias, bias
    load = x @ np.abs(r) + 1  # the sum of |value| in a row bounds the Hessian's row
    step = 1 / (0.25 * np.abs(r) * (load @ x) / n + PENALTY)
    b_step = 1 / (0.25 * float(load.mean()))
    for t in range(STEPS):
        ahead = t / (t + 3)
        v, c = w + ahead * (w - before), b + ahead * (b - b_before)
        error = 1 / (1 + np.exp(-np.clip(x @ (v * r) + c, -30, 30))) - y
        before, b_before = w, b
        w = (v - step * (r * (error @ x) / n + PENALTY * v)).astype(np.float32)
        b = float(c - b_step * error.mean())
    return w.astype(float), b


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score`` for every row, from the whole text alone; null texts are empty, repeated rows and null ids are kept."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            scores = [model.score(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    return texts(docs).mapInArrow(run, "doc_id long, score double")


def classify(docs: DataFrame, labels: DataFrame, most: int = MAX_TRAINING_ROWS) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``.

    Fitted on at most ``most`` labelled rows outside the held-out fold (see
    ``training_rows`` for nulls and repeats). Without labels of both classes the
    score is the same for all. Empty tables give no rows; other columns of either
    table are ignored.
    """
    model = fit(training_rows(docs, labels, "toxic", FOLDS, HELD_OUT, most))
    return score(docs, model).select(
        "doc_id",
        (fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
