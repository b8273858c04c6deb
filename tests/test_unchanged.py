"""Upserts that leave alone what the table holds already, and rows that are ranked in the buckets they lie in."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tests.build import bronze, silver_rows, tx
from tests.test_tables import at, contents
from txlake.operators import quality, silver
from txlake.sources import keys, tables
from txlake.sources.fx import fx_rates

UPSERTS = [tables.upsert_silver, keys.upsert_indexed]


@pytest.mark.parametrize("upsert", UPSERTS)
def test_rows_that_the_table_holds_are_not_written_again(spark, folder, upsert):
    path = f"{folder}/silver"
    first = silver_rows(spark, at(1, "a"), at(2, "b"), at(3, "c"), at(4, "d"))
    upsert(spark, first, path)
    files = set(spark.read.parquet(path).inputFiles())
    tables.track_changes(spark, path, "reader")
    upsert(spark, first, path)
    assert set(spark.read.parquet(path).inputFiles()) == files
    assert tables.noted_changes(spark, path, "reader") == ([], [])
    upsert(spark, silver_rows(spark, at(1, "a"), at(2, "b", 7.0), at(5, "c")), path)  # as it was, changed, moved
    assert contents(spark, path) == [("a", 1, 100.0), ("b", 2, 7.0), ("c", 5, 100.0), ("d", 4, 100.0)]
    assert [d.day for d in tables.noted_changes(spark, path, "reader")[0]] == [2, 3, 5]
    assert len(files & set(spark.read.parquet(path).inputFiles())) == 2


@pytest.mark.parametrize("upsert", UPSERTS)
def test_a_null_moved_to_another_column_and_a_signed_zero_are_changes(spark, folder, upsert):
    path = f"{folder}/silver"
    row = silver_rows(spark, at(1, "a"), at(1, "b"))
    one = row.withColumns({"channel": F.lit("X"), "device_id": F.lit(None).cast("string"), "amount": F.lit(0.0)})
    two = one.withColumns({"channel": F.lit(None).cast("string"), "device_id": F.lit("X")})
    for batch in (one, two, two.withColumn("amount", F.lit(-0.0))):
        upsert(spark, batch.select(row.columns), path)
        shown = [(r.channel, r.device_id, str(r.amount)) for r in tables.read_silver(spark, path).collect()]
        assert shown == [(r.channel, r.device_id, str(r.amount)) for r in batch.collect()]


@pytest.mark.parametrize("upsert", UPSERTS)
def test_a_key_that_the_table_holds_several_times_is_made_one(spark, folder, upsert):
    path = f"{folder}/silver"
    one = silver_rows(spark, at(1, "a"))
    copies = [silver_rows(spark, at(d, "a", float(d))) for d in (2, 3, 4)]
    table = one.unionByName(silver_rows(spark, at(5, "z")))
    for copy in copies:
        table = table.unionByName(copy)
    table.write.partitionBy("event_date").parquet(path)
    upsert(spark, one, path)
    assert contents(spark, path) == [("a", 1, 100.0), ("z", 5, 100.0)]


def test_latest_and_rejected_equal_the_two_halves(spark):
    records = [tx(transaction_id=f"t{i % 5}", amount=float(i - 3), offset=i) for i in range(20)]
    made = bronze(spark, *records).withColumn("bucket", F.substring("data.transaction_id", 2, 1))
    tagged = silver.tagged_silver(made, fx_rates(spark), ("bucket",))
    kept = silver.latest_and_rejected(tagged, ("bucket",))
    valid = kept.filter("is_valid")
    latest = silver.deduplicate(silver.valid_rows(tagged))
    assert sorted(map(repr, valid.select(latest.columns).collect())) == sorted(map(repr, latest.collect()))
    halves = [silver.quarantined_rows(df, F.lit(0)) for df in (kept, tagged)]
    assert sorted(map(repr, halves[0].collect())) == sorted(map(repr, halves[1].collect()))
    assert halves[0].count() == 4 and latest.count() == 5


def test_rows_that_win_are_a_source_merged_over_a_target(spark):
    records = [tx(transaction_id=f"t{i % 7}", amount=float(i + 1), offset=i) for i in range(20)]
    made = bronze(spark, *records).withColumn("bucket", F.substring("data.transaction_id", 2, 1))
    valid = silver.valid_rows(silver.tagged_silver(made, fx_rates(spark), ("bucket",)), ("bucket",))
    old = F.col("_offset") < 5
    apart = [silver.deduplicate(valid.filter(side)) for side in (~old, old)]
    merged = tables.merged_rows(*apart)
    found = silver.deduplicate(valid, within=("bucket",), wins=old)
    assert sorted(map(repr, found.collect())) == sorted(map(repr, merged.select(found.columns).collect()))
    assert {r.amount for r in found.collect()} == {1.0, 2.0, 3.0, 4.0, 5.0, 20.0, 14.0}
    with pytest.raises(ValueError, match="ranked within"):
        silver.deduplicate(valid, wins=old)


def test_ids_are_counted_without_the_other_states(spark):
    rows = silver_rows(spark, at(1, "a"), at(2, "b"))
    profile = quality.quality_profile(rows.unionByName(rows), 0)
    plan = profile._jdf.queryExecution().optimizedPlan().toString()
    assert "count(distinct" not in plan.lower()
    line = profile.first()
    assert (line.row_count, line.distinct_transaction_ids, line.duplicate_ids) == (4, 2, 2)
    assert quality.quality_profile(rows.limit(0), 0).first().distinct_transaction_ids == 0
