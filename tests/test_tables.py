from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from tests.build import bronze, silver_rows, tx
from txlake.operators import silver
from txlake.sources import shared, snapshot, tables
from txlake.sources.fx import fx_rates


MARKERS = "mapreduce.fileoutputcommitter.marksuccessfuljobs"


def contents(spark, path):
    rows = tables.read_silver(spark, path).orderBy("transaction_id").collect()
    return [(r.transaction_id, r.event_date.day, r.amount) for r in rows]


def at(day, name, amount=100.0):
    return tx(transaction_id=name, timestamp=f"2026-06-{day:02d}T10:00:00+00:00", amount=amount)


@pytest.mark.parametrize("unit", ["day", "month"])
def test_upsert_replaces_inserts_and_moves_days(spark, folder, unit):
    path = f"{folder}/silver"
    tables.upsert_silver(spark, silver_rows(spark, at(1, "a"), at(2, "b")), path, unit=unit)
    for _ in range(2):
        batch = silver_rows(spark, at(3, "b", 7.0), at(3, "c"))
        tables.upsert_silver(spark, batch, path, unit=unit)
        assert contents(spark, path) == [("a", 1, 100.0), ("b", 3, 7.0), ("c", 3, 100.0)]
    assert not shared.exists(spark, tables._pending_path(path))


def test_an_emptied_day_leaves_no_folder(spark, folder):
    path = f"{folder}/silver"
    tables.upsert_silver(spark, silver_rows(spark, at(2, "b")), path)
    tables.upsert_silver(spark, silver_rows(spark, at(3, "b")), path)
    days = [n for n in shared.child_names(spark, path) if n.startswith("event_date=")]
    assert days == ["event_date=2026-06-03"]


@pytest.mark.parametrize("moves_before_crash", [0, 1, 2])
def test_a_publish_cut_short_is_finished_later(spark, folder, monkeypatch, moves_before_crash):
    path = f"{folder}/silver"
    tables.upsert_silver(spark, silver_rows(spark, at(1, "a"), at(2, "b"), at(4, "d")), path)
    real, made = shared.rename, []

    def failing(session, source, target):
        if len(made) == moves_before_crash:
            raise OSError("driver lost")
        made.append(target)
        real(session, source, target)

    monkeypatch.setattr(shared, "rename", failing)
    batch = silver_rows(spark, at(1, "a", 9.0), at(3, "b", 7.0), at(3, "c"))
    if moves_before_crash < 2:
        with pytest.raises(OSError):
            tables.upsert_silver(spark, batch, path)
    else:
        tables.upsert_silver(spark, batch, path)
    monkeypatch.setattr(shared, "rename", real)
    assert tables.publish_pending(spark, path) == (moves_before_crash < 2)
    want = [("a", 1, 9.0), ("b", 3, 7.0), ("c", 3, 100.0), ("d", 4, 100.0)]
    assert contents(spark, path) == want
    assert tables.publish_pending(spark, path) is False


def test_optimise_keeps_contents(spark, folder):
    path = f"{folder}/silver"
    tables.upsert_silver(spark, silver_rows(spark, at(1, "a"), at(2, "b")), path)
    before = contents(spark, path)
    tables.optimize_silver(spark, path)
    tables.optimize_silver(spark, path, days=[date(2026, 6, 1)])
    tables.optimize_silver(spark, f"{folder}/missing")
    assert contents(spark, path) == before


def test_merged_rows_prefer_the_source(spark):
    target = silver_rows(spark, at(1, "a"), at(2, "b"))
    source = silver_rows(spark, at(3, "b", 7.0))
    rows = tables.merged_rows(target, source).orderBy("transaction_id").collect()
    assert [(r.transaction_id, r.amount) for r in rows] == [("a", 100.0), ("b", 7.0)]


@pytest.mark.parametrize("days, kept", [(2, 3), (0, 1), (-1, 4)])
def test_horizon(spark, days, kept):
    dates = [(date(2026, 6, d),) for d in (1, 8, 9, 10)]
    frame = spark.createDataFrame(dates, "ingestion_date DATE")
    assert tables.horizon_filter(frame, date(2026, 6, 10), days).count() == kept


def test_horizon_prunes_partitions(spark, folder):
    frame = spark.createDataFrame([(1, date(2026, 6, 1)), (2, date(2026, 6, 9))], "v INT, ingestion_date DATE")
    frame.write.partitionBy("ingestion_date").parquet(f"{folder}/b")
    read = tables.read_bronze(spark, f"{folder}/b", date(2026, 6, 10))
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ingestion_date" in plan
    assert read.count() == 1


def test_quarantine_appends_and_can_skip_known_rows(spark, folder):
    path = f"{folder}/q"
    rejected = silver.quarantined_rows(
        silver.tagged_silver(bronze(spark, tx(amount=-1.0), tx(currency="xxx")), fx_rates(spark))
    )
    assert tables.append_quarantine(rejected.filter("false"), path) is False
    assert tables.append_quarantine(rejected, path)
    assert tables.append_quarantine(rejected, path)
    assert tables.append_quarantine(rejected, path, seen_keys=["transaction_id", "_offset"]) is False
    unnamed = rejected.withColumn("transaction_id", F.lit(None).cast("string"))
    assert tables.append_quarantine(unnamed, f"{path}2", seen_keys=["transaction_id", "_offset"])
    assert tables.append_quarantine(unnamed, f"{path}2", seen_keys=["transaction_id", "_offset"]) is False
    assert tables.read_quarantine(spark, path).count() == 4
    rejected.withColumn("note", F.lit("new")).write.mode("append").parquet(path)
    assert "note" in tables.read_quarantine(spark, path).columns


def test_rejects_are_known_by_their_messages_coordinates(spark, folder):
    bad = bronze(spark, tx(transaction_id=None, amount=-1.0), tx(transaction_id=None, amount=-1.0))
    both = bad.withColumns({"source_topic": F.lit("t"), "_partition": F.col("_offset") % 2, "_offset": F.lit(5)})
    rejected = silver.quarantined_rows(silver.tagged_silver(both, fx_rates(spark)))
    keys = ("source_topic", "_partition", "_offset")
    for wanted in (True, False):
        assert tables.append_quarantine(rejected, f"{folder}/q", keys) is wanted
    assert tables.read_quarantine(spark, f"{folder}/q").select(*keys).distinct().count() == 2


def test_gold_views(spark, folder):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        tables.register_gold_views(spark, folder, ["some_gold"])
    rows = spark.createDataFrame([(1,)], "n INT")
    tables.write_gold(rows.filter("false"), f"{folder}/some_gold")
    tables.register_gold_views(spark, folder, ["some_gold"])
    assert spark.table("some_gold").count() == 0
    tables.write_gold(rows.withColumn("more", F.lit(2)), f"{folder}/some_gold")
    tables.register_gold_views(spark, folder, ["some_gold"])
    assert spark.table("some_gold").first().asDict() == {"n": 1, "more": 2}


def test_snapshot_and_restore(spark, folder):
    held = {"silver": f"{folder}/silver", "gold": f"{folder}/gold"}
    with pytest.raises(ValueError, match="writers"):
        snapshot.snapshot_tables(spark, held, f"{folder}/s", writers_paused=False)
    with pytest.raises(ValueError, match="no folder for: gold, silver"):
        snapshot.snapshot_tables(spark, held, f"{folder}/s", writers_paused=True)
    tables.upsert_silver(spark, silver_rows(spark, at(1, "a"), at(2, "b")), held["silver"])
    with pytest.raises(ValueError, match="no folder for: gold"):
        snapshot.snapshot_tables(spark, held, f"{folder}/s", writers_paused=True)
    assert not shared.exists(spark, f"{folder}/s")
    spark.range(3).write.parquet(held["gold"])
    manifest = snapshot.snapshot_tables(spark, held, f"{folder}/s", writers_paused=True)
    assert {r["table"]: r["rows"] for r in manifest.collect()} == {"silver": 2, "gold": 3}
    with pytest.raises(ValueError, match="already holds files"):
        snapshot.snapshot_tables(spark, held, f"{folder}/s", writers_paused=True)
    names = snapshot.restore_tables(
        spark, f"{folder}/s", f"{folder}/back", partitions={"silver": "event_date"}
    )
    assert names == ["gold", "silver"]
    assert contents(spark, f"{folder}/back/silver") == contents(spark, held["silver"])
    with pytest.raises(ValueError, match="target is not empty"):
        snapshot.restore_tables(spark, f"{folder}/s", f"{folder}/back")
    spark.range(1).write.mode("append").parquet(f"{folder}/s/gold")
    with pytest.raises(ValueError, match="differs"):
        snapshot.restore_tables(spark, f"{folder}/s", f"{folder}/other")
    assert not shared.exists(spark, f"{folder}/other")


def test_a_change_during_the_copy_is_noticed(spark, folder, monkeypatch):
    spark.range(3).write.parquet(f"{folder}/gold")
    real = snapshot._signatures

    def meddling(session, found):
        spark.range(1).write.mode("append").parquet(f"{folder}/gold")
        return real(session, found)

    monkeypatch.setattr(snapshot, "_signatures", meddling)
    with pytest.raises(ValueError, match="written to while"):
        snapshot.snapshot_tables(spark, {"gold": f"{folder}/gold"}, f"{folder}/s", writers_paused=True)
    assert not shared.exists(spark, f"{folder}/s/_manifest")


@pytest.fixture(params=[True, False])
def success_markers(spark, request):
    """Clusters may turn the marker files of finished jobs off."""
    spark._jsc.hadoopConfiguration().set(MARKERS, str(request.param).lower())
    yield request.param
    spark._jsc.hadoopConfiguration().unset(MARKERS)


def test_upserts_do_not_need_success_markers(spark, folder, success_markers):
    path = f"{folder}/silver"
    for marked_first in (False, True):
        if marked_first:  # a table from before the markers were turned off
            spark._jsc.hadoopConfiguration().set(MARKERS, "true")
        tables.upsert_silver(spark, silver_rows(spark, at(1, "a"), at(2, "b")), f"{path}{marked_first}")
        spark._jsc.hadoopConfiguration().set(MARKERS, str(success_markers).lower())
        tables.upsert_silver(spark, silver_rows(spark, at(3, "b", 7.0), at(3, "c")), f"{path}{marked_first}")
        assert contents(spark, f"{path}{marked_first}") == [("a", 1, 100.0), ("b", 3, 7.0), ("c", 3, 100.0)]
        tables.optimize_silver(spark, f"{path}{marked_first}")
        assert len(contents(spark, f"{path}{marked_first}")) == 3
    rows = spark.createDataFrame([(1,)], "n INT")
    for n in (1, 2):
        tables.write_gold(rows.withColumn("m", F.lit(n)), f"{folder}/g")
        assert spark.read.parquet(f"{folder}/g").first().m == n


@pytest.mark.parametrize("text", ["{", "[]", '{"filled": []}', ""])
def test_an_unreadable_plan_is_an_error(spark, folder, text):
    path = f"{folder}/silver"
    tables.upsert_silver(spark, silver_rows(spark, at(1, "a")), path)
    spark.createDataFrame([(text,)], "v STRING").write.text(f"{tables._pending_path(path)}/plan")
    with pytest.raises(ValueError, match="unreadable plan"):
        tables.upsert_silver(spark, silver_rows(spark, at(2, "b")), path)
    assert contents(spark, path) == [("a", 1, 100.0)]


def test_only_staged_tables_are_discarded(spark, folder):
    spark.range(3).write.parquet(f"{folder}/own")
    staged = shared.stage(spark.range(2), "t")
    for df in (spark.read.parquet(f"{folder}/own"), staged, spark.range(1)):
        shared.discard(df)
    assert spark.read.parquet(f"{folder}/own").count() == 3
    with pytest.raises(Exception, match="FILE_NOT_EXIST|FileNotFound|does not exist"):
        staged.count()


def test_a_failed_gold_write_leaves_the_old_table(spark, folder):
    path = f"{folder}/gold"
    tables.write_gold(spark.range(3), path)
    with pytest.raises(Exception, match="USER_RAISED"):
        tables.write_gold(spark.range(3).withColumn("x", F.raise_error(F.lit("no"))), path)
    assert spark.read.parquet(path).count() == 3
    tables.write_gold(spark.range(2), path)
    assert spark.read.parquet(path).count() == 2


def test_bronze_lists_only_days_inside_the_horizon(spark, folder):
    rows = [(d, date(2026, 6, d)) for d in (1, 8, 9, 10)]
    frame = spark.createDataFrame(rows, "v INT, ingestion_date DATE")
    frame.write.partitionBy("ingestion_date").parquet(f"{folder}/b")
    read = tables.read_bronze(spark, f"{folder}/b", date(2026, 6, 10))
    assert {r.v for r in read.collect()} == {8, 9, 10} and read.schema == spark.read.parquet(f"{folder}/b").schema
    assert not any("2026-06-01" in f for f in read.inputFiles())
    assert tables.read_bronze(spark, f"{folder}/b", date(2027, 1, 1)).count() == 0
    assert tables.read_bronze(spark, f"{folder}/b", date(2026, 6, 10), -1).count() == 4
