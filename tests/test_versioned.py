"""Versioned tables: a reader sees the old or the new table, never a mixture."""

from __future__ import annotations

from datetime import date

import pytest

from tests.build import silver_rows
from tests.test_tables import at
from txlake.sources import keys, shared
from txlake.sources.versioned import VersionedTable

PARTITION = "event_date"


def rows_of(df):
    return sorted((r.transaction_id, r.event_date.day, r.amount) for r in df.collect())


OLD = [("a", 1, 100.0), ("b", 2, 100.0)]
NEW = [("a", 1, 100.0), ("b", 3, 7.0), ("c", 3, 100.0)]


@pytest.fixture
def table(spark, folder):
    found = VersionedTable(spark, f"{folder}/silver", PARTITION)
    keys.upsert_indexed(spark, silver_rows(spark, at(1, "a"), at(2, "b")), found.path, versioned=True)
    return found


def test_every_step_of_a_publish_shows_one_version(spark, table, monkeypatch):
    seen, opened = [], []
    for name in ("rename", "write_text", "replace_file", "delete"):
        real = getattr(shared, name)

        def stepping(*args, real=real, **kwargs):
            seen.append(rows_of(table.read()))
            opened.append(table.read())
            result = real(*args, **kwargs)
            seen.append(rows_of(table.read()))
            return result

        monkeypatch.setattr(shared, name, stepping)
    keys.upsert_indexed(spark, silver_rows(spark, at(3, "b", 7.0), at(3, "c")), table.path, versioned=True)
    monkeypatch.undo()
    assert seen[0] == OLD and seen[-1] == NEW
    changes = [i for i in range(1, len(seen)) if seen[i] != seen[i - 1]]
    assert len(changes) == 1 and all(s in (OLD, NEW) for s in seen)
    assert rows_of(opened[0]) == OLD  # opened before, read after
    assert rows_of(table.read(version=1)) == OLD and table.versions() == [1, 2]


@pytest.mark.parametrize("step", ["rename", "write_text", "replace_file"])
def test_a_publish_cut_short_changes_nothing(spark, table, monkeypatch, step):
    def failing(*args):
        raise OSError("driver lost")

    batch = silver_rows(spark, at(3, "b", 7.0), at(3, "c"))
    with monkeypatch.context() as patch, pytest.raises(OSError):
        patch.setattr(shared, step, failing)
        keys.upsert_indexed(spark, batch, table.path, versioned=True)
    assert rows_of(table.read()) == OLD and table.version() == 1 and table.versions() == [1]
    keys.upsert_indexed(spark, batch, table.path, versioned=True)
    assert rows_of(table.read()) == NEW
    table.vacuum()
    assert rows_of(table.read()) == NEW and table.versions() == [2]
    assert sorted(shared.child_names(spark, table.path)) == ["current", "data", "manifests"]


def test_vacuum_keeps_what_it_is_told_to(spark, table):
    for day in (3, 4, 5):
        keys.upsert_indexed(spark, silver_rows(spark, at(day, "b", float(day))), table.path, versioned=True)
    assert table.vacuum(keep=2) == 2  # of days 2 and 3; day 4 is in the version before
    assert table.versions() == [3, 4]
    assert rows_of(table.read(version=3)) == [("a", 1, 100.0), ("b", 4, 4.0)]
    with pytest.raises(ValueError, match="no version 1"):
        table.read(version=1)
    table.register("versioned_view")
    assert rows_of(spark.table("versioned_view")) == [("a", 1, 100.0), ("b", 5, 5.0)]


def test_some_partitions_none_and_no_version(spark, table, folder):
    assert rows_of(table.read([date(2026, 6, 2)])) == [("b", 2, 100.0)]
    assert rows_of(table.read([date(2026, 7, 2)])) == []
    assert table.values() == [date(2026, 6, 1), date(2026, 6, 2)]
    with pytest.raises(ValueError, match="not replaced: 2026-06-02"):
        table.replace(table.read(), [date(2026, 6, 1)])
    table.replace(table.read([]), table.values())
    assert rows_of(table.read()) == [] and not table.filled()
    empty = VersionedTable(spark, f"{folder}/none", PARTITION)
    assert empty.version() == 0 and not empty.filled()
    with pytest.raises(ValueError, match="no version"):
        empty.read()
