"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` alone, a null text as the empty one."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )


def unused(name: str, df: DataFrame) -> str:
    """A column name that a frame doesn't have, whatever the case of its letters."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


def slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches into short ones, so that Python holds few rows at a time."""
    for batch in batches:
        for begin in range(0, batch.num_rows, rows):
            yield batch.slice(begin, rows)
