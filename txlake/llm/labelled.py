"""Labelled rows to fit a classifier on, and folds that are held out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(doc_id: Column, folds: int) -> Column:
    """CRC-32 of the id as text, modulo ``folds``; a null id is in fold 0."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds, F.lit(0))


def training_rows(docs: DataFrame, labels: DataFrame, label: str, folds: int, held_out: int, most: int) -> DataFrame:
    """``text, y`` of documents with a label, outside the held-out fold.

    At most ``most`` labelled ids are used, those with the smallest hashes; so the
    list has a fixed bound and is broadcast, and the documents are read where they
    lie. Of contradicting labels the larger counts; null labels and ids don't.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull()).groupBy("doc_id").agg(
        F.max(F.col(label)).cast("int").alias("y")
    )
    usable = known.where(fold(F.col("doc_id"), folds) != held_out)
    chosen = usable.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return rows.join(F.broadcast(chosen), "doc_id").select("text", "y")
