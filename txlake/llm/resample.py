"""Importance resampling towards a target text, with bit-sliced weights.

A document's features are its words and pairs of words, hashed into buckets. A
bucket's gain is the log ratio of its share in the target to its share in all
documents. A document's weight is the mean gain of its features: its bucket counts
are cut into bit planes of one bit per bucket, each is ANDed with the planes of the
gains of either sign, and popcounts times powers of two add up to the exact sum.
Documents are drawn without replacement by weight plus Gumbel noise, which only
depends on the id.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator
from itertools import accumulate, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from txlake.llm.common import slices, texts
from txlake.sources.shared import stage

BUCKETS = 10_000
#: Gains, weights and noise are whole thousandths.
UNIT = 1000
LEAST_WORDS = 20
PERCENT = 25
SEED = 7
#: Copies of one row of the result that one task writes in a go.
COPIES = 4096

#: A-Z become a-z; every other ASCII character but letters and digits parts words.
_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words(text: str) -> list[bytes]:
    return text.encode().translate(_WORDS).split()


def feature_buckets(said: list[bytes]) -> np.ndarray:
    """The buckets of all words and pairs of neighbours, repeats included: their CRC-32 modulo the buckets."""
    alone = list(map(zlib.crc32, said))
    spaced = map(zlib.crc32, repeat(b" "), alone)
    pairs = list(map(zlib.crc32, said[1:], spaced))  # carried on behind "word "
    return np.array(alone + pairs, np.int64) % BUCKETS


def planes(values: np.ndarray) -> np.ndarray:
    """Bit planes of non-negative numbers, lowest first: a row of 64-bit words with one bit per bucket."""
    many = max(1, int(values.max(initial=0)).bit_length())
    bits = (values[None, :] >> np.arange(many)[:, None] & 1).astype(np.uint8)
    packed = np.packbits(np.pad(bits, ((0, 0), (0, -values.size % 64))), axis=1)
    return packed.view(np.uint64)


class GainPlanes:
    """Planes of the positive and of the negative gains."""

    def __init__(self, gains: np.ndarray):
        self.sides = [(sign, planes(np.maximum(sign * gains, 0))) for sign in (1, -1)]

    def weighed(self, counts: np.ndarray) -> int:
        """The sum of count times gain over all buckets, exactly."""
        sliced, total = planes(counts), 0
        for sign, gain in self.sides:
            met = np.bitwise_count(sliced[:, None, :] & gain[None, :, :]).sum(axis=2, dtype=np.int64)
            p, q = met.shape
            sums = np.zeros(p + q - 1, np.int64)  # by the power of two
            for i in range(p):
                sums[i : i + q] += met[i]
            total += sign * sum(int(n) << k for k, n in enumerate(sums))
        return total


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of smoothed shares, rounded down."""
    s, t = float(source.sum()) + BUCKETS, float(target.sum()) + BUCKETS
    ratios = [math.floor(UNIT * math.log((b + 1.0) * s / ((a + 1.0) * t))) for a, b in zip(source.tolist(), target.tolist(), strict=True)]
    return np.array(ratios, np.int64)


def noise(doc_id: int | None, seed: int = SEED) -> int:
    """Gumbel noise in thousandths, rounded down, from a hash of the id alone."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-UNIT * math.log(-math.log((h + 0.5) / 4294967296)))


def bucket_counts(rows: DataFrame) -> np.ndarray:
    """Features of all texts by bucket. A task gives one row per bucket, the driver gets ``BUCKETS``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in slices(batches):
            found = [feature_buckets(words(t)) for t in batch.column("text").to_pylist()]
            total += np.bincount(np.concatenate(found), minlength=BUCKETS)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held.astype(np.int32)), pa.array(total[held])], names=["bucket", "n"])

    summed = rows.select("text").mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    counts = np.zeros(BUCKETS, np.int64)
    for row in summed.collect():
        counts[row.bucket] = row.n
    return counts


def weighed(docs: DataFrame, target: DataFrame, seed: int = SEED) -> DataFrame:
    """``doc_id, n_words, n_features, weight, score`` for every row."""
    rows = texts(docs)
    told = target.select(F.coalesce(F.col("text"), F.lit("")).alias("text"))
    levels = gains(bucket_counts(rows), bucket_counts(told))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sliced = GainPlanes(levels)
        for batch in slices(batches):
            out = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                said = words(text)
                found = feature_buckets(said)
                weight = sliced.weighed(np.bincount(found, minlength=BUCKETS)) // len(found) if len(found) else 0
                out.append((doc_id, len(said), len(found), weight, weight + noise(doc_id, seed)))
            columns = zip(*out, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["doc_id", "n_words", "n_features", "weight", "score"])

    return rows.mapInArrow(run, "doc_id long, n_words long, n_features long, weight long, score long")


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED) -> DataFrame:
    """``doc_id, n_features, weight, score, rank`` for every row; the drawn ones are ranked 1, 2, 3..., the others null.

    Of the rows with ``least_words`` words or more, ``percent`` in a hundred are drawn,
    rounded down: the highest scores, ties to the smaller ``doc_id``. A null or empty
    text has no features and weight 0, and a null ``doc_id`` the noise of the empty id
    and the last place among ties; rows alike in all columns share their ranks out;
    other columns of both tables are ignored; an empty target has no features, an
    empty table gives no rows.

    Rows alike travel as one with their number. Scores are whole numbers between
    bounds that the formulas set, some 200,000 at most however many rows there are,
    so rows per score come to the driver and ranks before a score are broadcast.
    """
    spark = docs.sparkSession
    alike = weighed(docs, target, seed).groupBy("doc_id", "n_words", "n_features", "weight", "score").agg(F.count("*").alias("n"))
    alike = stage(alike, "weighed")
    able = F.col("n_words") >= least_words
    per_score = alike.where(able).groupBy("score").agg(F.sum("n").alias("n")).toPandas().sort_values("score", ascending=False)
    drawn = percent * int(per_score["n"].sum()) // 100
    before = [0, *accumulate(int(n) for n in per_score["n"])][: len(per_score)]
    ahead = [(int(s), b) for s, b in zip(per_score["score"], before, strict=True) if b < drawn]
    ahead = spark.createDataFrame(ahead, "score long, ahead long")
    inside = W.partitionBy("score").orderBy(F.asc_nulls_last("doc_id"), "n_features", "weight", "n_words").rowsBetween(W.unboundedPreceding, -1)
    high = alike.where(able).join(F.broadcast(ahead), "score")
    high = high.withColumn("first", F.col("ahead") + F.coalesce(F.sum("n").over(inside), F.lit(0)) + 1)
    low = alike.join(F.broadcast(ahead), "score", "left").where(~able | F.col("ahead").isNull()).withColumn("first", F.lit(None).cast("long"))
    columns = ["doc_id", "n_features", "weight", "score", "first", "n"]
    every = high.select(columns).unionByName(low.select(columns))
    blocks = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / COPIES)))
    every = every.withColumn("block", blocks)
    copies = F.sequence(F.col("block") * COPIES, F.least(F.col("n"), (F.col("block") + 1) * COPIES) - 1)
    every = every.withColumn("copy", F.explode(copies)).withColumn("place", F.col("first") + F.col("copy"))
    return every.select("doc_id", "n_features", "weight", "score", F.when(F.col("place") <= drawn, F.col("place")).alias("rank"))
