"""Clustering over two keys: equal rows, fewer files for either filter."""

from __future__ import annotations

import glob

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from txlake.sources import layout


def files_with(path, column, value):
    """Files whose statistics don't rule a value out."""
    held = 0
    for name in glob.glob(f"{path}/*.parquet"):
        meta = pq.ParquetFile(name).metadata
        at = meta.schema.names.index(column)
        stats = [meta.row_group(i).column(at).statistics for i in range(meta.num_row_groups)]
        held += any(s.min <= value <= s.max for s in stats)
    return held


def test_both_filters_skip_files(spark, folder):
    rows = spark.range(20_000).select(
        F.format_string("t%06d", "id").alias("transaction_id"),
        F.date_add(F.lit("2026-01-01").cast("date"), (F.col("id") % 64).cast("int")).alias("event_date"),
        F.format_string("A%03d", F.pmod(F.xxhash64("id"), F.lit(500))).alias("account_id"),
    )
    by_day = rows.repartitionByRange(16, "event_date", "account_id", "transaction_id").sortWithinPartitions("event_date", "account_id")
    by_day.write.parquet(f"{folder}/day")
    layout.cluster_interleaved(rows, 16).write.parquet(f"{folder}/both")
    both, day = spark.read.parquet(f"{folder}/both"), rows.agg(F.max("event_date")).first()[0]
    assert both.exceptAll(rows).count() == 0 and both.count() == rows.count()
    assert files_with(f"{folder}/day", "account_id", "A250") == 16
    assert files_with(f"{folder}/both", "account_id", "A250") <= 6
    assert files_with(f"{folder}/both", "event_date", day) <= 6


def test_keys_are_interleaved_and_odd_tables_pass(spark):
    pair = spark.range(256).select((F.col("id") % 16).cast("int").alias("a"), F.floor(F.col("id") / 16).cast("int").alias("b"))
    for r in pair.withColumn("z", layout.interleaved(F.col("a"), F.col("b"), 4)).collect():
        assert r.z == sum((r.a >> k & 1) << (2 * k + 1) | (r.b >> k & 1) << (2 * k) for k in range(4))
    schema = "transaction_id string, event_date date, account_id string"
    assert layout.cluster_interleaved(spark.createDataFrame([], schema)).count() == 0
    nulls = spark.createDataFrame([("a", None, None), (None, None, "x\"y\\"), ("a", None, None)], schema)
    assert sorted(map(repr, layout.cluster_interleaved(nulls).collect())) == sorted(map(repr, nulls.collect()))
