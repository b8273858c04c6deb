"""Bronze in buckets of its orders: silver is found without moving a row."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from txlake.operators import silver
from txlake.plans.fixtures import ORDER_KEY
from txlake.plans.lake import Lake
from txlake.sources import shared, tables


@pytest.fixture
def lake(spark, folder, monkeypatch):
    """Two thousand lines of 150 orders, two orders twice, in which many ids repeat; some lines have no order."""
    monkeypatch.setattr(shared, "shared_root", lambda spark: f"{folder}/shared")
    n = F.col("id")
    day = F.timestamp_add("DAY", (n % 40).cast("long"), F.lit("1997-01-01").cast("timestamp_ntz"))
    lines = spark.range(2000).select(
        F.when(n % 50 != 7, n % 160).alias("l_orderkey"),
        (n % 211).alias("l_partkey"),
        (n % 13).alias("l_suppkey"),
        (n % 7 + 1).cast("int").alias("l_linenumber"),
        (n / 7).alias("l_extendedprice"),
        day.alias("l_shipdate"),
    )
    orders = spark.range(152).select(
        (n % 150).alias("o_orderkey"), (n % 20).alias("o_custkey"), F.lit("1996-05-05").cast("timestamp_ntz").alias("o_orderdate")
    )
    customers = spark.range(20).select(n.alias("c_custkey"), (n % 25).cast("int").alias("c_nationkey"))
    for name, rows in (("lineitem", lines), ("orders", orders), ("customer", customers)):
        rows.write.parquet(f"{folder}/sf/{name}.parquet")
    return Lake(spark, f"{folder}/sf")


def shown(df):
    return sorted(map(repr, df.drop("quarantine_time").collect()))


def test_rows_are_ranked_where_the_join_has_dealt_them(lake):
    tagged = lake.tagged()
    expected = silver.deduplicate(silver.valid_rows(tagged))
    assert "hashpartitioning" in expected._jdf.queryExecution().executedPlan().toString()
    for found in (lake.latest(), lake.latest(F.col("_offset") % 2 == 0)):
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning" not in plan and "rangepartitioning" not in plan
    assert 0 < expected.count() < silver.valid_rows(tagged).count()
    assert shown(lake.silver()) == shown(expected)


def test_bronze_holds_every_line_in_its_bucket_and_by_day(lake):
    bronze = lake.tx_bronze()
    assert bronze.count() == sum(1 + (o < 2) for i in range(2000) if i % 50 != 7 and (o := i % 160) < 150)
    bucket = F.regexp_extract(F.input_file_name(), r"_(\d{5})\.c000", 1)
    placed = bronze.select(ORDER_KEY, bucket.alias("bucket")).distinct().collect()
    assert len(placed) == len({r.order_key for r in placed}) == 150 and len({r.bucket for r in placed}) > 1
    assert lake.tx_bronze().inputFiles() == bronze.inputFiles()  # stored once
    one = lake.spark.read.parquet(bronze.inputFiles()[0]).select("ingestion_date", "_offset").collect()
    assert one == sorted(one)


def test_stored_tables_are_small_and_only_those_that_are_read(lake, folder):
    lake.quarantined()
    assert shared.child_names(lake.spark, lake.root) == ["quarantine", "tx_bronze"]
    tables.upsert_silver(lake.spark, lake.latest(), f"{folder}/silver", unit="year")
    tables.write_gold(lake.silver(), f"{folder}/gold", "year")
    staged = shared.stage(lake.spark.range(9).toDF("n"), "numbers")
    stored = [lake.spark.read.parquet(f"{folder}/{name}") for name in ("silver", "gold")]
    for table in (lake.tx_bronze(), lake.silver(), lake.quarantined(), staged, *stored):
        assert table.inputFiles() and all(".zstd." in file for file in table.inputFiles())
