"""Rows laid out along two keys at once."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Each key is cut into so many ranges, a power of two, by a bounded sample. Cuts change the layout alone.
BITS = 8
SAMPLED = 1 << 16


def _cuts(df: DataFrame, column: str) -> list:
    """At most ``2 ** BITS - 1`` values that cut a column's rows into ranges of about equal size."""
    values = df.where(F.col(column).isNotNull()).select(column, F.xxhash64("transaction_id").alias("_draw"))
    sample = sorted(r[0] for r in values.orderBy("_draw").limit(SAMPLED).select(column).collect())
    if not sample:
        return []
    n = 1 << BITS
    return sorted({sample[i * len(sample) // n] for i in range(1, n)})


def _range_of(column: Column, cuts: list, kind: str) -> Column:
    """How many cuts are at or below a value, by binary search; a null is in the first range."""
    bounds = F.from_json(F.lit(json.dumps([str(c) for c in cuts])), "array<string>").cast(f"array<{kind}>")
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(BITS))])
    return F.aggregate(
        steps, F.lit(0), lambda low, step: F.when(F.get(bounds, low + step - 1) <= column, low + step).otherwise(low)
    )


def interleaved(first: Column, second: Column, bits: int = BITS) -> Column:
    """The bits of two small numbers in turn, the highest of ``first`` first."""
    key = F.lit(0)
    for k in range(bits):
        key = key.bitwiseOR(F.shiftleft(F.shiftright(first, k).bitwiseAND(F.lit(1)), 2 * k + 1))
        key = key.bitwiseOR(F.shiftleft(F.shiftright(second, k).bitwiseAND(F.lit(1)), 2 * k))
    return key


def cluster_interleaved(silver: DataFrame, files: int | None = None) -> DataFrame:
    """Rows ranged and sorted by the ranges of day and account in turn.

    Each file then holds a narrow range of both, so a filter on either skips files by
    their statistics; ``tables.clustered`` serves the day first and accounts inside it.
    """
    day = _range_of(F.col("event_date"), _cuts(silver, "event_date"), "date")
    account = _range_of(F.col("account_id"), _cuts(silver, "account_id"), "string")
    keyed = silver.withColumn("_z", interleaved(day, account))
    keys = ("_z", "event_date", "account_id", "transaction_id")
    ranged = keyed.repartitionByRange(*keys) if files is None else keyed.repartitionByRange(files, *keys)
    return ranged.sortWithinPartitions(*keys).drop("_z")
