"""Quality and gold by touched partitions, next to the whole-table jobs."""

from __future__ import annotations

import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from tests.build import silver_rows, tx
from tests.test_jobs import AS_OF, store_bronze
from tests.test_keys import spoil
from txlake.constants import GOLD_TABLES
from txlake.operators import drift, gold, quality, scoring, states
from txlake.plans import incremental, jobs
from txlake.sources import keys, reports, shared, tables


def rows(drawn, names):
    return [
        tx(
            transaction_id=n,
            timestamp=f"2026-06-{drawn.randint(1, 6):02d}T{drawn.randint(0, 23):02d}:00:00+00:00",
            amount=float(drawn.randint(1, 9000)),
            account_id=f"A{drawn.randint(1, 4)}",
            merchant_category=drawn.choice(["grocery", "travel", "gambling"]),
            country=drawn.choice(["PL", "DE"]),
        )
        for n in names
    ]


def state(spark, layout):
    found = {}
    for name in GOLD_TABLES:
        table = spark.read.parquet(f"{layout.gold}/{name}")
        found[name] = sorted(map(repr, table.select(*sorted(table.columns)).collect()))
    return found


@pytest.mark.parametrize("unit", ["day", "month"])
def test_gold_equals_a_full_recompute(spark, folder, unit):
    drawn = random.Random(3)
    layout, whole = jobs.Layout(f"{folder}/a", unit), jobs.Layout(f"{folder}/b", unit)
    for names in ("abcdefgh", "aceij", "j"):
        batch = shared.stage(silver_rows(spark, *rows(drawn, names)), "batch")
        for to in (layout, whole):
            keys.upsert_indexed(spark, batch, to.silver, unit=unit)
        incremental.run_gold(spark, layout)
        jobs.run_gold(spark, whole, "whole")
        assert state(spark, layout) == state(spark, whole)
    assert incremental.run_gold(spark, layout) == []
    assert state(spark, layout) == state(spark, whole)


@pytest.mark.parametrize("unit", ["day", "year"])
def test_rows_stay_in_the_tasks_that_read_or_sum_them(spark, folder, monkeypatch, unit):
    layout = jobs.Layout(folder, unit)
    keys.upsert_indexed(spark, silver_rows(spark, *rows(random.Random(5), "abcdefgh")), layout.silver, unit=unit)
    shuffles, replace = {}, tables.replace_partitions

    def counted(spark, rows, path, partition, days, arrange=None, changed=True):
        plan = arrange(rows)._jdf.queryExecution().sparkPlan().toString()
        ready = rows._jdf.queryExecution().executedPlan().toString()
        shuffles[path.rsplit("/", 1)[1]] = (plan.count("REBALANCE"), ready.count("Exchange"))
        replace(spark, rows, path, partition, days, arrange, changed)

    monkeypatch.setattr(tables, "replace_partitions", counted)
    incremental.run_gold(spark, layout)
    assert shuffles["fraud_signals"] == shuffles["scored_transactions"] == (0, 0)
    assert all(n == 0 for n, _ in shuffles.values())
    monkeypatch.setattr(incremental, "FEW_PARTITIONS", 0)
    shared.delete(spark, layout.gold)
    shared.delete(spark, f"{layout.root}/state")
    incremental.run_gold(spark, layout)
    summed = {t: n for t, (n, _) in shuffles.items() if t not in ("fraud_signals", "scored_transactions")}
    assert set(summed.values()) == {1} and shuffles["fraud_signals"] == (0, 0)


def test_gold_reads_only_what_changed(spark, folder):
    layout = jobs.Layout(folder)
    first = [tx(transaction_id=n, timestamp=f"2026-06-{d:02d}T10:00:00+00:00") for n, d in (("a", 1), ("b", 2), ("c", 3))]
    keys.upsert_indexed(spark, silver_rows(spark, *first), layout.silver)
    assert [d.day for d in incremental.run_gold(spark, layout)] == [1, 2, 3]
    spoil(layout.silver, 1)
    for table in ("daily_volume_by_country", "account_velocity", "fraud_signals", "scored_transactions"):
        spoil(f"{layout.gold}/{table}", 1)
    moved = silver_rows(spark, tx(transaction_id="b", timestamp="2026-06-03T11:00:00+00:00", amount=7.0))
    keys.upsert_indexed(spark, moved, layout.silver)
    assert [d.day for d in incremental.run_gold(spark, layout)] == [2, 3]
    names = shared.child_names(spark, f"{layout.gold}/daily_volume_by_country")
    assert "event_date=2026-06-02" not in names  # emptied by the move
    kpi = spark.read.parquet(f"{layout.gold}/merchant_category_kpi").first()
    assert (kpi.tx_count, kpi.total_volume_pln) == (3, 207.0)


def test_a_gold_run_cut_short_is_made_up_for(spark, folder, monkeypatch):
    layout = jobs.Layout(folder)
    keys.upsert_indexed(spark, silver_rows(spark, tx(transaction_id="a")), layout.silver)
    incremental.run_gold(spark, layout)
    keys.upsert_indexed(spark, silver_rows(spark, tx(transaction_id="b", amount=50.0)), layout.silver)
    real = incremental._refresh

    def failing(session, to, path, build, days):
        if path.endswith("fraud_signals"):
            raise OSError("driver lost")
        real(session, to, path, build, days)

    with monkeypatch.context() as patch, pytest.raises(OSError):
        patch.setattr(incremental, "_refresh", failing)
        incremental.run_gold(spark, layout)
    assert len(incremental.run_gold(spark, layout)) == 1
    whole = gold.merchant_category_kpi(tables.read_silver(spark, layout.silver)).first()
    assert spark.read.parquet(f"{layout.gold}/merchant_category_kpi").first() == whole
    assert spark.read.parquet(f"{layout.gold}/fraud_signals").count() == 2


def test_a_publish_finished_late_is_noted(spark, folder, monkeypatch):
    layout = jobs.Layout(folder)
    keys.upsert_indexed(spark, silver_rows(spark, tx(transaction_id="a")), layout.silver)
    incremental.run_gold(spark, layout)

    def failing(*args):
        raise OSError("driver lost")

    with monkeypatch.context() as patch, pytest.raises(OSError):
        patch.setattr(shared, "rename", failing)
        keys.upsert_indexed(spark, silver_rows(spark, tx(transaction_id="a", amount=9.0)), layout.silver)
    assert len(incremental.run_gold(spark, layout)) == 1  # which finishes the publish first
    assert spark.read.parquet(f"{layout.gold}/scored_transactions").first().amount == 9.0


def test_another_threshold_scores_all_rows_anew(spark, folder):
    layout = jobs.Layout(folder)
    risky = tx(transaction_id="a", amount=9000.0, merchant_category="gambling", country="CN", channel="ONLINE")
    keys.upsert_indexed(spark, silver_rows(spark, risky), layout.silver)
    for threshold in (0.01, 0.9999):
        incremental.run_gold(spark, layout, threshold)
        score = scoring.add_fraud_scores(tables.read_silver(spark, layout.silver), None, threshold).first()
        found = spark.read.parquet(f"{layout.gold}/scored_transactions").first()
        assert (found.fraud_score, found.fraud_flag) == (score.fraud_score, score.fraud_flag)


def test_profiles_merge_to_the_whole_tables(spark):
    drawn = random.Random(1)
    made = silver_rows(spark, *rows(drawn, "aabbcdefgh"))
    odd = made.withColumn("amount_pln", F.when(F.col("country") == "DE", F.lit(1e27)).otherwise(F.col("amount_pln")))
    odd = odd.withColumn("account_id", F.when(F.col("transaction_id") == "c", None).otherwise(F.col("account_id")))
    for silver in (made, odd, made.limit(0)):
        silver = shared.stage(silver, "rows")
        whole = quality.quality_profile(silver, 3, "run").first()
        state = states.quality_state(silver, "event_date")
        apart = silver.select("transaction_id", "event_date").distinct().groupBy("transaction_id").count()
        more = apart.agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0))).first()[0]
        assert states.merged_profile(state, more, 3, "run").first() == whole
        unfit = state.agg(F.coalesce(F.sum("pln_unfit"), F.lit(0))).first()[0]
        assert unfit == silver.where("amount_pln > 1e26").count()
        kpi = gold.merchant_category_kpi(silver).orderBy("merchant_category").collect()
        assert states.category_kpi(states.category_state(silver, "event_date")).orderBy("merchant_category").collect() == kpi


def test_silver_job_with_index_equals_the_plain_one(spark, folder):
    records = [tx(transaction_id=n, timestamp=f"2026-06-{d:02d}T10:00:00+00:00") for n, d in (("a", 11), ("b", 12), ("a", 13))]
    records += [tx(transaction_id="bad", amount=-1.0)]
    plain, indexed = jobs.Layout(f"{folder}/plain"), jobs.Layout(f"{folder}/indexed")
    for layout, run in ((plain, jobs.run_silver), (indexed, incremental.run_silver)):
        for i, run_id in enumerate(("one", "two")):
            store_bronze(spark, layout, *[{**r, "offset": 10 * i + k} for k, r in enumerate(records)])
            run(spark, layout, run_id, AS_OF)
        jobs.require_gate(spark, layout, "two", 0.9)
    for run_id in ("one", "two"):
        found = [reports.read_report(spark, x.reports, "quality_metrics", run_id).first() for x in (plain, indexed)]
        assert found[0] == found[1]
    a, b = (sorted(map(repr, tables.read_silver(spark, x.silver).collect())) for x in (plain, indexed))
    assert a == b and len(a) == 2
    assert AS_OF == date(2026, 6, 14)


def test_drift_from_histograms_equals_the_whole_tables(spark, folder):
    drawn = random.Random(9)
    layout = jobs.Layout(folder)
    names = [f"t{i}" for i in range(60)]
    for part in (names[:40], names[20:]):  # some rows move to another day
        keys.upsert_indexed(spark, shared.stage(silver_rows(spark, *rows(drawn, part)), "batch"), layout.silver)
        incremental.run_gold(spark, layout)
    scored = spark.read.parquet(f"{layout.gold}/scored_transactions")
    cut = date(2026, 6, 4)
    for since in (None, cut):
        live = scored if since is None else scored.where(F.col("event_date") >= F.lit(since))
        reference = scored.where(F.col("event_date") < F.lit(cut))
        whole = sorted(map(tuple, drift.drift_report(reference, live, run_id="r").collect()))
        stored = incremental.live_values(spark, layout, before=cut)
        assert sorted(map(tuple, incremental.write_drift(spark, layout, "r", since, stored).collect())) == whole
    assert {r.psi for r in incremental.write_drift(spark, layout, "none").collect()} == {0.0}  # the heuristic has no reference
    spoil(f"{layout.root}/state/values", 1)  # a window reads only its own days
    assert incremental.live_values(spark, layout, since=cut).count() > 0
