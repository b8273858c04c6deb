from __future__ import annotations

import inspect
from datetime import UTC, date, datetime

import pytest
from pyspark.sql import functions as F

from tests.build import bronze, silver_rows, tx
from txlake.operators import scoring, training
from txlake.plans import jobs
from txlake.sources import reports, shared, tables

AS_OF = date(2026, 6, 14)
RECORDS = [
    tx(transaction_id="a"),
    tx(transaction_id="b", amount=100.0, currency="EUR"),
    tx(transaction_id="c", amount=20.0, account_id="A2"),
    tx(transaction_id="c", amount=25.0, account_id="A2", offset=99),
]


def store_bronze(spark, layout, *records):
    rows = bronze(spark, *records).withColumn("ingestion_date", F.lit(date(2026, 6, 13)))
    rows.write.mode("append").partitionBy("ingestion_date").parquet(layout.bronze)


def gold_state(spark, layout):
    day = spark.read.parquet(f"{layout.gold}/daily_volume_by_country").first()
    scored = spark.read.parquet(f"{layout.gold}/scored_transactions")
    return day.tx_count, day.total_volume_pln, scored.count()


def test_pipeline_twice_gives_the_same_tables(spark, folder):
    layout = jobs.Layout(folder)
    store_bronze(spark, layout, *RECORDS)
    for run_id in ("one", "two"):
        assert jobs.run_pipeline(spark, layout, run_id, AS_OF) == "NO_RETRAIN"
        assert gold_state(spark, layout) == (3, 555.0, 3)
    assert not shared.exists(spark, layout.model)
    drift = reports.read_report(spark, layout.reports, "drift_metrics", "two").collect()
    assert {r.feature: (r.reference_n, r.live_n) for r in drift} == {
        "fraud_score": (0, 3),
        "amount_pln": (0, 3),
    }


def test_a_failing_gate_leaves_gold_alone(spark, folder):
    layout = jobs.Layout(folder)
    store_bronze(spark, layout, *RECORDS)
    jobs.run_pipeline(spark, layout, "one", AS_OF)
    before = gold_state(spark, layout)
    store_bronze(spark, layout, tx(transaction_id="d"), tx(transaction_id="bad", amount=-1.0))
    with pytest.raises(jobs.GateFailed, match="quarantine ratio 0.200 exceeds max 0.050"):
        jobs.run_pipeline(spark, layout, "two", AS_OF)
    assert gold_state(spark, layout) == before
    assert tables.read_silver(spark, layout.silver).count() == 4
    assert tables.read_quarantine(spark, layout.quarantine).count() == 1
    jobs.run_pipeline(spark, layout, "three", AS_OF, max_quarantine_ratio=0.5)
    assert gold_state(spark, layout)[0] == 4


def test_the_gate_wants_a_report(spark, folder):
    with pytest.raises(jobs.GateFailed, match="no quality report"):
        jobs.require_gate(spark, jobs.Layout(folder), "none")


def test_gold_steps_run_alone(spark, folder):
    layout = jobs.Layout(folder)
    tables.upsert_silver(spark, silver_rows(spark, *RECORDS), layout.silver)
    with pytest.raises(ValueError, match="unknown step"):
        jobs.run_gold(spark, layout, "r", "everything")
    jobs.run_gold(spark, layout, "r", "aggregates")
    assert not shared.exists(spark, f"{layout.gold}/scored_transactions")
    jobs.run_gold(spark, layout, "r", "scoring", threshold=0.0)
    assert spark.read.parquet(f"{layout.gold}/scored_transactions").filter("fraud_flag").count() == 3
    jobs.run_gold(spark, layout, "r", "drift", sample_size=2)
    report = reports.read_report(spark, layout.reports, "drift_metrics", "r")
    assert {r.live_n for r in report.collect()} == {2}


def test_a_missing_drift_report_keeps_the_gate_closed(spark, folder):
    row = jobs.retraining_verdict(spark, jobs.Layout(folder), "none").first()
    assert (row.verdict, row.reason) == ("NO_RETRAIN", "no_metrics")


def labelled(spark, n=600):
    """Frauds are the online gambling rows, with some noise."""
    i = F.col("id")
    risky = i % 10 == 0
    return spark.range(n).select(
        F.concat(F.lit("t"), i.cast("string")).alias("transaction_id"),
        F.timestamp_seconds(F.lit(1781352005) + i * 777).alias("event_time"),
        F.to_date(F.lit("2026-06-13")).alias("event_date"),
        F.concat(F.lit("A"), (i % 40).cast("string")).alias("account_id"),
        (F.lit(50.0) + i % 90).alias("amount_pln"),
        F.when(risky, "gambling").otherwise("grocery").alias("merchant_category"),
        F.lit("PL").alias("country"),
        F.when(risky, "ONLINE").otherwise("POS").alias("channel"),
        ((risky & (i % 70 != 0)) | (i % 97 == 0)).alias("is_fraud_label"),
    )


def test_split_is_exact_per_class_and_repeatable(spark):
    rows = labelled(spark)
    split = training.stratified_split(rows)
    counts = split.groupBy("is_fraud_label").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("is_holdout").alias("held")
    )
    for row in counts.collect():
        assert row.held == -(-row.n // 4)
    again = training.stratified_split(rows.repartition(7))
    assert split.exceptAll(again).isEmpty()
    assert not training.stratified_split(rows, seed=7).exceptAll(split).isEmpty()


def test_training_beats_no_skill_and_can_be_loaded(spark, folder):
    path = f"{folder}/model"
    assert scoring.load_or_default(spark, path).kind == "heuristic"
    row = training.train(spark, labelled(spark), path, rounds=3).first()
    assert row.roc_auc > 0.8
    assert row.pr_auc > 2 * row.holdout_positive_rate
    assert row.n_samples == 600
    assert row.holdout_n == 150 or row.holdout_n == 151
    assert len(row.reference_quantiles.amount_pln) == 11
    scorer = scoring.load_or_default(spark, path)
    assert scorer.kind == "spark_ml"
    kept = {r.feature: r.n for r in scorer.reference.groupBy("feature").agg(F.sum("n").alias("n")).collect()}
    assert kept == {"amount_pln": 600, "fraud_score": 600 - row.holdout_n}  # every row counts
    scored = scoring.add_fraud_scores(labelled(spark), scorer)
    assert scored.columns[-2:] == ["fraud_score", "fraud_flag"]
    assert scored.filter("fraud_score < 0 OR fraud_score > 1").count() == 0


def test_drift_from_a_model_reference_leads_to_training(spark, folder):
    layout = jobs.Layout(folder)
    training.train(spark, labelled(spark), layout.model, rounds=2)
    shifted = labelled(spark).withColumn("amount_pln", F.col("amount_pln") * 10)
    scorer = scoring.load_or_default(spark, layout.model)
    jobs.write_scores(shifted, layout, scorer, None)
    jobs.write_drift(spark, layout, scorer, "r")
    row = jobs.retraining_verdict(spark, layout, "r").first()
    assert row.verdict == "RETRAIN"
    assert "amount_pln" in row.triggered_by


@pytest.mark.parametrize("damaged", ["metadata", "reference", "model"])
def test_an_unusable_model_leaves_the_heuristic(spark, folder, caplog, damaged):
    layout = jobs.Layout(folder)
    training.train(spark, labelled(spark), layout.model, rounds=1)
    shared.delete(spark, f"{layout.model}/{damaged}")
    spark.createDataFrame([("{broken",)], "v STRING").write.text(f"{layout.model}/{damaged}")
    assert scoring.load_or_default(spark, layout.model).kind == "heuristic"
    assert "unusable" in caplog.text


def test_a_model_is_trained_with_a_hundred_rounds_unless_told_otherwise():
    for job in (training.fit_gbt, training.train):
        assert inspect.signature(job).parameters["rounds"].default == 100


def test_the_metadata_is_dated_by_the_caller(spark, folder):
    row = training.train(spark, labelled(spark), folder, rounds=1, now=datetime(2026, 6, 1, tzinfo=UTC)).first()
    assert row.trained_at == "2026-06-01T00:00:00+00:00"
