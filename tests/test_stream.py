from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from tests.build import tx
from txlake.schemas import envelope_schema
from txlake.streaming import bronze_stream as S


def drop_file(spark, path, ids):
    lines = [("A1", json.dumps(tx(transaction_id=i)), "transactions.raw", 0, n, None)
             for n, i in enumerate(ids)]
    frame = spark.createDataFrame(lines, envelope_schema()).withColumn(
        "timestamp", F.timestamp_seconds(F.lit(1781352005))
    )
    frame.coalesce(1).write.mode("append").parquet(path)


def run(spark, folder, **options):
    source = S.read_file_stream(spark, f"{folder}/in", **options)
    S.run_bronze(source, f"{folder}/bronze", f"{folder}/checkpoint")
    return spark.read.parquet(f"{folder}/bronze")


def test_replay_adds_nothing_and_a_new_file_is_added_once(spark, folder):
    drop_file(spark, f"{folder}/in", ["a", "b", "b"])
    assert run(spark, folder).count() == 3
    assert run(spark, folder).count() == 3
    drop_file(spark, f"{folder}/in", ["c"])
    ids = run(spark, folder).groupBy("data.transaction_id").count().collect()
    assert {r[0]: r[1] for r in ids} == {"a": 1, "b": 2, "c": 1}


def test_rate_limit_gives_several_batches(spark, folder):
    for name in ("a", "b", "c"):
        drop_file(spark, f"{folder}/in", [name])
    source = S.read_file_stream(spark, f"{folder}/in", max_files_per_trigger=1)
    query = S.run_bronze(source, f"{folder}/bronze", f"{folder}/checkpoint")
    assert len([p for p in query.recentProgress if p["numInputRows"]]) == 3
    assert spark.read.parquet(f"{folder}/bronze").count() == 3


def test_bronze_is_partitioned_by_utc_ingestion_day(spark, folder):
    drop_file(spark, f"{folder}/in", ["a"])
    row = run(spark, folder).select(
        "ingestion_date",
        F.date_from_unix_date((F.floor(F.unix_seconds("ingestion_time") / 86400)).cast("int")),
    ).first()
    assert row[0] == row[1]


class Writer:
    def trigger(self, **kwargs):
        return kwargs


@pytest.mark.parametrize("name", ["availableNow", "available_now", "once"])
def test_draining_triggers(name):
    assert S.apply_trigger(Writer(), name) == {"availableNow": True}


def test_interval_trigger():
    assert S.apply_trigger(Writer(), "10 seconds") == {"processingTime": "10 seconds"}


def test_progress_tells_the_rows_of_each_batch(spark, folder):
    for names in (["a", "b"], ["c"], ["d", "e", "f"]):
        drop_file(spark, f"{folder}/in", names)
    source = S.read_file_stream(spark, f"{folder}/in", max_files_per_trigger=1)
    query = S.run_bronze(source, f"{folder}/bronze", f"{folder}/checkpoint")
    assert S.batch_sizes(query) == [(0, 2), (1, 1), (2, 3)]
    again = S.run_bronze(S.read_file_stream(spark, f"{folder}/in"), f"{folder}/bronze", f"{folder}/checkpoint")
    assert S.batch_sizes(again) == []
