"""The key index and the upsert that follows the batch."""

from __future__ import annotations

import os
import random

import pytest

from tests.build import silver_rows
from tests.test_tables import at, contents
from txlake.sources import keys, shared, tables

KEY, PARTITION = "transaction_id", "event_date"


def pairs(spark, path, buckets=keys.BUCKETS):
    rows = spark.read.parquet(keys._index_path(path, buckets)).select(KEY, PARTITION).distinct().collect()
    return sorted((r[0], r[1].day) for r in rows)


def spoil(path, day):
    """Damage a partition: whatever reads it fails."""
    folder = f"{path}/{PARTITION}=2026-06-{day:02d}"
    for name in os.listdir(folder):
        if name.endswith(".crc"):
            os.remove(f"{folder}/{name}")
        else:
            with open(f"{folder}/{name}", "wb") as file:
                file.write(b"no parquet")


@pytest.mark.parametrize("unit", ["day", "month"])
def test_equals_the_plain_upsert(spark, folder, unit):
    drawn = random.Random(5)
    for _ in range(3):
        names = drawn.sample("abcdefghijkl", drawn.randint(1, 6))
        batch = shared.stage(silver_rows(spark, *[at(drawn.randint(1, 9), n, float(drawn.randint(1, 99))) for n in names]), "batch")
        tables.upsert_silver(spark, batch, f"{folder}/plain", unit=unit)
        keys.upsert_indexed(spark, batch, f"{folder}/indexed", unit=unit, buckets=4)
        assert contents(spark, f"{folder}/indexed") == contents(spark, f"{folder}/plain")
        held = sorted((n, d) for n, d, _ in contents(spark, f"{folder}/indexed"))
        if unit == "day":
            assert set(held) <= set(pairs(spark, f"{folder}/indexed", 4))


def test_only_touched_partitions_are_read(spark, folder):
    path = f"{folder}/silver"
    keys.upsert_indexed(spark, silver_rows(spark, at(1, "a"), at(2, "b"), at(4, "d"), at(5, "e")), path)
    spoil(path, 1)
    spoil(path, 4)
    days = keys.upsert_indexed(spark, silver_rows(spark, at(3, "b", 7.0), at(5, "f")), path)
    assert [d.day for d in days] == [2, 3, 5]
    assert tables.partition_values(spark, path, PARTITION)[0].day == 1
    with pytest.raises(Exception, match="(?i)parquet"):
        tables.upsert_silver(spark, silver_rows(spark, at(3, "g")), path)


def test_a_table_without_an_index_gets_one(spark, folder):
    path = f"{folder}/silver"
    tables.upsert_silver(spark, silver_rows(spark, at(1, "a"), at(2, "b")), path)
    assert not shared.exists(spark, tables.index_root(path))
    keys.upsert_indexed(spark, silver_rows(spark, at(3, "b", 7.0)), path)
    assert contents(spark, path) == [("a", 1, 100.0), ("b", 3, 7.0)]
    tables.upsert_silver(spark, silver_rows(spark, at(4, "c")), path)  # the index knows nothing of it
    assert not shared.exists(spark, tables.index_root(path))
    keys.upsert_indexed(spark, silver_rows(spark, at(5, "c", 8.0)), path)
    assert contents(spark, path) == [("a", 1, 100.0), ("b", 3, 7.0), ("c", 5, 8.0)]


@pytest.mark.parametrize("lost", ["before the data", "before the move", "in the move"])
def test_a_crash_between_index_and_data(spark, folder, monkeypatch, lost):
    path = f"{folder}/silver"
    keys.upsert_indexed(spark, silver_rows(spark, at(1, "a"), at(2, "b")), path)
    batch = silver_rows(spark, at(3, "b", 7.0), at(4, "c"))

    def failing(*args, **kwargs):
        raise OSError("driver lost")

    name = {"before the data": "replace_partitions", "before the move": "publish_pending", "in the move": "rename"}[lost]
    with monkeypatch.context() as patch:
        patch.setattr(shared if name == "rename" else tables, name, failing)
        if name == "publish_pending":  # it also runs first, with nothing to do
            real, calls = tables.publish_pending, []
            patch.setattr(tables, name, lambda *a: failing() if calls else calls.append(1))
        with pytest.raises(OSError, match="driver lost"):
            keys.upsert_indexed(spark, batch, path)
    assert {("b", 3), ("c", 4)} <= set(pairs(spark, path))
    if lost == "before the data":
        assert contents(spark, path) == [("a", 1, 100.0), ("b", 2, 100.0)]
        # the key is still found in its old place, although the index also names the new one
        keys.compact(tables.FolderTable(spark, path, PARTITION), KEY)
        assert pairs(spark, path) == [("a", 1), ("b", 2), ("c", 4)]
    keys.upsert_indexed(spark, silver_rows(spark, at(6, "b", 9.0)), path)
    after = [("a", 1, 100.0), ("b", 6, 9.0)] + ([] if lost == "before the data" else [("c", 4, 100.0)])
    assert contents(spark, path) == after
    keys.upsert_indexed(spark, batch, path)
    assert contents(spark, path) == [("a", 1, 100.0), ("b", 3, 7.0), ("c", 4, 100.0)]


def test_compaction_drops_what_keys_have_left_behind(spark, folder, monkeypatch):
    path = f"{folder}/silver"
    for day in (1, 2, 3):
        keys.upsert_indexed(spark, silver_rows(spark, at(day, "a", float(day)), at(9, "z")), path)
    assert pairs(spark, path) == [("a", 1), ("a", 2), ("a", 3), ("z", 9)]
    monkeypatch.setattr(keys, "COMPACT_AFTER", 0)
    keys.upsert_indexed(spark, silver_rows(spark, at(4, "a", 4.0)), path)
    assert pairs(spark, path) == [("a", 4), ("z", 9)]
    assert contents(spark, path) == [("a", 4, 4.0), ("z", 9, 100.0)]
    assert keys.repeats(tables.FolderTable(spark, path, PARTITION), KEY) == 0
    spark.read.parquet(path).where("transaction_id = 'a'").selectExpr("* except (event_date)", "date'2026-06-09' as event_date").write.mode("append").partitionBy(PARTITION).parquet(path)
    shared.delete(spark, tables.index_root(path))
    keys.build_index(tables.FolderTable(spark, path, PARTITION), KEY)
    assert keys.repeats(tables.FolderTable(spark, path, PARTITION), KEY) == 1


def test_an_empty_batch_and_null_keys(spark, folder):
    path = f"{folder}/silver"
    rows = silver_rows(spark, at(1, "a"))
    assert keys.upsert_indexed(spark, rows.limit(0), path) == []
    assert len(keys.upsert_indexed(spark, rows, path)) == 1
    for _ in range(2):  # a null key replaces nothing
        nameless = rows.selectExpr("* except (transaction_id)", "cast(null as string) as transaction_id").select(rows.columns)
        keys.upsert_indexed(spark, nameless, path)
    assert tables.read_silver(spark, path).count() == 3
    assert pairs(spark, path) == [("a", 1)]
