"""SimHash fingerprints and near-duplicate classes by pivot distance tables.

Every fingerprint has a row in a table of its Hamming distances to fixed reference
fingerprints (pivots), kept apart for the four quarters of the bits. By the
triangle inequality fingerprints within ``BITS`` differ by no more than that in
every whole distance; and as two differing bits leave two quarters untouched, they
agree in all pivot distances over some pair of quarters. So the table is joined
with itself on the distances over each pair of quarters, pairs with a larger
coordinate difference are discarded, and the survivors are verified bit by bit.
Nothing is lost, and equal fingerprints enter once.
"""

from __future__ import annotations

import itertools
import random
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txlake.llm.common import slices, texts
from txlake.llm.graph import components
from txlake.sources.shared import stage

SEED = 42
SHINGLE_WORDS = 3
BITS = 2
PIVOTS = 12
QUARTERS = [0xFFFF << (16 * i) for i in range(4)]
#: Shingle hashes whose bits are counted at once.
COUNTED = 1 << 14


def shingle_hashes(text: str, words: int = SHINGLE_WORDS) -> np.ndarray:
    """A hash for every shingle of a text, repeats included; none without words."""
    tokens = text.encode().lower().split()  # bytes: only A-Z change, and only ASCII white space splits
    if not tokens:
        return np.zeros(0, np.uint64)
    line = b" ".join(tokens)
    ends = np.cumsum([len(t) + 1 for t in tokens]) - 1
    begins = np.concatenate([[0], ends[:-1] + 1]).tolist()
    stops = ends[min(words, len(tokens)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(line[a:b], SEED) for a, b in zip(begins, stops, strict=False)), np.uint64, len(stops))


def fingerprint(text: str, words: int = SHINGLE_WORDS) -> int:
    """Bits set in over half of the hashes of a text's shingles; 0 without words."""
    hashes = shingle_hashes(text, words)
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), COUNTED):
        part = hashes[i : i + COUNTED].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = SHINGLE_WORDS) -> DataFrame:
    """``doc_id, fp``: the fingerprint as a signed long. A null text is an empty one, with fingerprint 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1024):
            found = np.array([fingerprint(t, words) for t in batch.column("text").to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found.view(np.int64))], names=["doc_id", "fp"])

    return texts(docs).mapInArrow(run, "doc_id long, fp long")


def pivots(n: int = PIVOTS) -> list[int]:
    """Reference fingerprints, the same in every run."""
    drawn = random.Random(SEED)
    return [drawn.getrandbits(64) for _ in range(n)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _distance(fp: Column, pivot: int, mask: int) -> Column:
    return F.bit_count(fp.bitwiseXOR(F.lit(_signed(pivot))).bitwiseAND(F.lit(_signed(mask)))).cast("byte")


def pivot_table(fps: DataFrame, n: int = PIVOTS) -> DataFrame:
    """``node, fp``, whole distances ``d0..`` and for each pair of quarters a ``key`` of the distances over it."""
    part = [[_distance(F.col("fp"), p, q) for p in pivots(n)] for q in QUARTERS]
    whole = [reduce(lambda a, b: a + b, [part[q][j] for q in range(4)]).cast("byte").alias(f"d{j}") for j in range(n)]
    keys = [
        F.xxhash64(F.lit(k), *part[a], *part[b])
        for k, (a, b) in enumerate(itertools.combinations(range(4), 2))
    ]
    return fps.select("node", "fp", *whole, F.explode(F.array(*keys)).alias("key"))


def near_pairs(fps: DataFrame, bits: int = BITS, n: int = PIVOTS) -> DataFrame:
    """``a, b``: nodes of distinct fingerprints within ``bits`` (at most 2, by the quarters) of each other."""
    if not 0 <= bits <= 2:
        raise ValueError("quarters find at most two differing bits")
    rows = stage(pivot_table(fps, n), "pivots")
    left, right = rows.alias("l"), rows.alias("r")
    near = [F.abs(F.col(f"l.d{j}").cast("int") - F.col(f"r.d{j}").cast("int")) <= bits for j in range(n)]
    verified = F.bit_count(F.col("l.fp").bitwiseXOR(F.col("r.fp"))) <= bits
    return (
        left.join(right, (F.col("l.key") == F.col("r.key")) & (F.col("l.fp") < F.col("r.fp")) & reduce(lambda a, b: a & b, near) & verified)
        .select(F.col("l.node").alias("a"), F.col("r.node").alias("b"))
    )


def near_duplicates(docs: DataFrame, words: int = SHINGLE_WORDS, bits: int = BITS) -> DataFrame:
    """``doc_id, fp, component_id``: the smallest ``doc_id`` that links reach, for every row.

    A null or empty text has fingerprint 0 and links like any other; texts of fewer
    words than a shingle are one shingle; repeated rows and equal fingerprints share
    a component; rows with a null ``doc_id`` come back with their class but name
    none (a class of only such rows has a null component); other columns are
    ignored; an empty table gives no rows.
    """
    rows = stage(fingerprints(docs, words), "fingerprints")
    classes = stage(rows.groupBy("fp").agg(F.min("doc_id").alias("node")), "classes")
    joined = components(near_pairs(classes.where("node IS NOT NULL"), bits))
    named = classes.join(joined, classes.node == joined.id, "left").select(
        "fp", F.coalesce("component", "node").alias("component_id")
    )
    return rows.join(stage(named, "named"), "fp").select("doc_id", "fp", "component_id")
