"""Sorts whose share of rows doesn't grow with the table, and tables that a query doesn't need."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from txlake.constants import SILVER_COLUMNS
from txlake.operators import silver
from txlake.plans import serving
from txlake.plans.lake import Lake
from txlake.sources import shared, tables

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture
def stored(spark, folder):
    """600 rows of 200 ids, 300 more of one id and 3 without, in files."""
    n = F.col("id")
    made = {
        "transaction_id": F.when(n < 600, F.concat(F.lit("T"), n % 200)).when(n < 900, "hot"),
        "account_id": F.concat(F.lit("A"), n % 7),
        "event_date": F.date_add(F.lit("2026-01-01").cast("date"), (n % 5).cast("int")),
        "event_time": F.timestamp_seconds(n),
        "ingestion_time": F.timestamp_seconds(n % 450),
        "_offset": n,
    }
    rows = spark.range(903).select(*[made.get(c, F.lit("x")).alias(c) for c in SILVER_COLUMNS])
    rows.repartition(5).write.parquet(f"{folder}/rows")
    return spark.read.parquet(f"{folder}/rows")


def parts_of(df):
    return df.select(F.spark_partition_id()).distinct().count()


def test_a_large_table_is_deduplicated_in_more_tasks(spark, stored, monkeypatch):
    assert shared.more_partitions(stored) is None and shared.more_partitions(spark.range(9)) is None
    expected = sorted(map(repr, silver.deduplicate(stored).collect()))
    assert len(expected) == 202
    monkeypatch.setattr(shared, "SORTED_BYTES", -(-shared.stored_bytes(stored) // 40))
    assert shared.more_partitions(stored) == 40
    monkeypatch.setattr(silver, "ID_BUCKETS", 64)
    for hot_ids in (True, False):
        found = silver.deduplicate(stored, hot_ids)
        assert sorted(map(repr, found.collect())) == expected
        assert parts_of(found) > 20
    # the hot id is cut to a row a task before it travels, the others are not sorted twice
    plan = silver.deduplicate(stored)._jdf.queryExecution().executedPlan().toString()
    assert "Union" in plan and "REPARTITION_BY_NUM" in plan


def test_large_tables_are_merged_and_clustered_in_more_tasks(stored, monkeypatch):
    once = stored.where("_offset < 200 or transaction_id is null")
    batch = stored.where("_offset >= 500 and _offset < 600")
    expected = sorted(map(repr, tables.merged_rows(once, batch).collect()))
    assert len(expected) == 203
    monkeypatch.setattr(shared, "SORTED_BYTES", -(-shared.stored_bytes(stored) // 40))
    assert sorted(map(repr, tables.merged_rows(once, batch).collect())) == expected
    ranged = tables.clustered(stored)
    assert parts_of(ranged) > 20 and ranged.count() == 903


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not present")
def test_a_query_builds_only_the_tables_it_reads(spark, monkeypatch, folder):
    monkeypatch.setattr(shared, "shared_root", lambda spark: folder)
    lake = Lake(spark, SF_DIR)
    scored = lake.scored()
    assert {"fraud_score", "fraud_flag"} <= set(scored.columns)
    assert shared.child_names(spark, lake.root) == ["silver", "tx_bronze"]
    root = lake.build_gold(serving.tables_of("q7_score_by_label"))
    assert shared.child_names(spark, root) == ["scored_transactions"]
    assert sorted(map(repr, lake.scored().collect())) == sorted(map(repr, scored.collect()))
