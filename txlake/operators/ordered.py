"""Running totals over a value order, spread over the cluster.

A window without PARTITION BY sorts everything in one task. Here equal values
are first combined, the value axis is cut into chunks, each chunk is summed on
its own and shifted by the total of the chunks below it. Where the cuts fall
affects only the balance, never the result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MAX_CHUNKS = 4096


def _chunk_count(df: DataFrame) -> int:
    """Several chunks per shuffle partition, so that hashing spreads them evenly."""
    wanted = 8 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(8, min(wanted, MAX_CHUNKS))


def value_cuts(df: DataFrame, value: str, chunks: int | None = None) -> list[float]:
    """Inner cut points that split the rows into chunks of about equal size.

    At most ``MAX_CHUNKS`` numbers come to the driver, from a mergeable sketch.
    """
    n = min(chunks or _chunk_count(df), MAX_CHUNKS)
    found = df.approxQuantile(value, [i / n for i in range(1, n)], 1 / (2 * n))
    infinite = (float("inf"), float("-inf"))
    return sorted({cut for cut in found if cut not in infinite}) or [0.0]


def running_totals(
    df: DataFrame,
    value: str,
    measures: Sequence[str],
    by: Sequence[str] = (),
    per_key: dict[str, Column] | None = None,
    chunks: int | None = None,
    few_keys: bool = True,
) -> DataFrame:
    """Per distinct ``value``: each measure ``m``, ``cum_m`` (sum up to here), ``total_m``.

    ``by`` restarts the totals per key; it is meant for a handful of keys, such
    as feature names or class labels, and one key may hold nearly all rows. With keys
    without such a bound say ``few_keys=False``: then the chunk totals, up to
    ``MAX_CHUNKS`` rows per key, are joined as Spark sees fit and not broadcast.
    ``per_key`` adds columns computed from the ``total_m`` columns, once per
    chunk instead of once per row. Nulls in ``value`` are left out; NaN sorts last.
    """
    keys = list(by)
    rows = df.filter(F.col(value).isNotNull()).select(
        *keys, F.col(value).cast("double").alias(value), *measures
    )
    # The cuts are pooled over all keys: a chunk of one key holds no more rows than the pooled one.
    bounds = [float("-inf"), *value_cuts(rows, value, chunks), float("inf")]
    by_value = rows.groupBy(*keys, value).agg(*[F.sum(m).alias(m) for m in measures])
    chunked = (
        Bucketizer(splits=bounds, inputCol=value, outputCol="_bucket", handleInvalid="keep")
        .transform(by_value)
        .withColumn("_chunk", F.col("_bucket").cast("int"))
        .drop("_bucket")
    )
    # One row per key and chunk: at most MAX_CHUNKS + 1 rows per key are windowed and broadcast.
    whole = Window.partitionBy(*keys)
    below = whole.orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunk_sums = chunked.groupBy(*keys, "_chunk").agg(*[F.sum(m).alias(m) for m in measures])
    offsets = chunk_sums.select(
        *keys,
        "_chunk",
        *[F.coalesce(F.sum(m).over(below), F.lit(0)).alias(f"_below_{m}") for m in measures],
        *[F.sum(m).over(whole).alias(f"total_{m}") for m in measures],
    ).withColumns(per_key or {})
    inside = (
        Window.partitionBy(*keys, "_chunk")
        .orderBy(value)
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    local = chunked.select("*", *[F.sum(m).over(inside).alias(f"_local_{m}") for m in measures])
    # A left join, because an inner one would push a null check of the chunk down to the raw rows.
    return local.join(F.broadcast(offsets) if few_keys else offsets, [*keys, "_chunk"], "left").select(
        *keys,
        value,
        *measures,
        *[(F.col(f"_below_{m}") + F.col(f"_local_{m}")).alias(f"cum_{m}") for m in measures],
        *[f"total_{m}" for m in measures],
        *(per_key or {}),
    )


def unpivoted(df: DataFrame, features: Sequence[str], *kept: str | Column) -> DataFrame:
    """``feature, value`` rows, one per feature and row, in a single scan."""
    cells = F.explode(
        F.array(
            *[
                F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("value"))
                for f in features
            ]
        )
    )
    return df.select(cells.alias("_cell"), *kept).select("_cell.*", "*").drop("_cell")


def value_at_rank(value: str, cumulative: str, index: Column) -> Column:
    """Aggregate: the value at a 0-based rank, from a running-totals table."""
    return F.min(F.when(F.col(cumulative) > index, F.col(value)))


def deciles(df: DataFrame, features: Sequence[str], places: int = 6) -> DataFrame:
    """``feature, decile`` 0-10 and ``value``, interpolated between neighbouring ranks."""
    cells = unpivoted(df, features, F.lit(1).alias("n"))
    last = F.col("total_n") - 1
    ranks = {f"_lo{q}": F.floor(F.lit(q / 10) * last) for q in range(11)}
    ranks |= {f"_hi{q}": F.ceil(F.lit(q / 10) * last) for q in range(11)}
    totals = running_totals(cells, "value", ["n"], by=["feature"], per_key=ranks)
    picks = [value_at_rank("value", "cum_n", F.col(r)).alias(r[1:]) for r in ranks]
    picked = totals.groupBy("feature").agg(F.max(last).alias("last"), *picks)
    lines = []
    for q in range(11):
        position = F.lit(q / 10) * F.col("last")
        low, high = F.col(f"lo{q}"), F.col(f"hi{q}")
        at = F.round(low + (high - low) * (position - F.floor(position)), places)
        lines.append(F.struct(F.lit(q).alias("decile"), at.alias("value")))
    return picked.select("feature", F.explode(F.array(*lines)).alias("d")).select(
        "feature", "d.decile", "d.value"
    )


def empirical_cdf(df: DataFrame, value: str) -> DataFrame:
    """Share of rows at or below each distinct value."""
    totals = running_totals(df.withColumn("_one", F.lit(1)), value, ["_one"])
    return totals.select(value, (F.col("cum__one") / F.col("total__one")).alias("cdf"))
