from __future__ import annotations

import json

import pytest

from tests.build import bronze, silver_rows, tx
from txlake.constants import QUALITY_CHECKS
from txlake.functions import money
from txlake.operators import quality, silver
from txlake.schemas import QUALITY_CHECKS_DDL, QUALITY_METRICS_DDL
from txlake.sources import reports
from txlake.sources.fx import fx_rates

METRICS = {
    "run_id": "r",
    "row_count": 1000,
    "distinct_transaction_ids": 1000,
    "duplicate_ids": 0,
    "null_transaction_id": 0,
    "null_account_id": 0,
    "null_amount": 0,
    "null_amount_pln": 0,
    "amount_min": 1.0,
    "amount_max": 500.0,
    "avg_amount_pln": 50.0,
    "fraud_count": 10,
    "fraud_rate": 0.01,
    "quarantined_count": 40,
}
PASSED = [(name, True) for name in QUALITY_CHECKS]


def gate(spark, changes=None, checks=PASSED, ratio=0.05):
    metrics = spark.createDataFrame([{**METRICS, **(changes or {})}], QUALITY_METRICS_DDL)
    lines = spark.createDataFrame([("r", *c) for c in checks], QUALITY_CHECKS_DDL)
    return sorted(r.failure for r in quality.quality_gate(metrics, lines, ratio).collect())


def test_gate_passes_and_fails_on_the_quarantine_share(spark):
    assert gate(spark) == []
    assert gate(spark, {"quarantined_count": 200}) == ["quarantine ratio 0.167 exceeds max 0.050"]
    empty = {k: type(v)(0) for k, v in METRICS.items() if k != "run_id"}
    assert gate(spark, {**empty, "amount_min": None, "amount_max": None}) == []


@pytest.mark.parametrize(
    "changes",
    [
        {"row_count": None},
        {"duplicate_ids": -1},
        {"null_amount_pln": None},
        {"amount_min": None},
        {"amount_max": float("inf")},
        {"amount_min": float("nan")},
    ],
)
def test_damaged_metrics_fail(spark, changes):
    assert gate(spark, changes) == [quality.BAD_METRICS]


@pytest.mark.parametrize(
    "checks, failure",
    [
        ([], quality.INCOMPLETE_CHECKS),
        (PASSED[1:], quality.INCOMPLETE_CHECKS),
        (PASSED + PASSED[:1], quality.INCOMPLETE_CHECKS),
        (PASSED + [(None, True)], quality.BAD_CHECKS),
        (PASSED[1:] + [(QUALITY_CHECKS[0], None)], quality.BAD_CHECKS),
        (PASSED + [("own_check", False)], "check failed: own_check"),
    ],
)
def test_damaged_or_failed_checks(spark, checks, failure):
    assert gate(spark, checks=checks) == [failure]


def test_a_stale_summary_cannot_hide_a_measured_failure(spark):
    assert gate(spark, {"duplicate_ids": 3}) == ["check failed: transaction_id_unique"]


@pytest.mark.parametrize("ratio", [float("nan"), -0.1, 1.5])
def test_threshold_must_be_a_share(spark, ratio):
    assert gate(spark, ratio=ratio) == [quality.BAD_THRESHOLD]


def test_profile_of_a_small_table(spark):
    rows = silver_rows(spark, tx(), tx(transaction_id="t2", amount=50.0, is_fraud_label=True))
    row = quality.quality_profile(rows.union(rows.filter("transaction_id = 't1'")), 7).first()
    assert (row.row_count, row.distinct_transaction_ids, row.duplicate_ids) == (3, 2, 1)
    assert (row.fraud_count, row.fraud_rate, row.quarantined_count) == (1, 0.33333, 7)
    assert (row.amount_min, row.amount_max, row.avg_amount_pln) == (50.0, 100.0, 83.33)


def test_profile_of_an_empty_table_passes_its_checks(spark):
    profile = quality.quality_profile(silver_rows(spark, tx()).filter("false"))
    row = profile.first()
    assert (row.row_count, row.fraud_count, row.fraud_rate, row.amount_min) == (0, 0, 0.0, None)
    assert all(r.passed for r in quality.quality_checks(profile).collect())


def test_expectations_count_unexpected_rows(spark):
    tagged = silver.tagged_silver(
        bronze(
            spark,
            tx(),
            tx(),
            tx(transaction_id=None),
            tx(transaction_id="t3", currency="xxx", amount=-1.0),
        ),
        fx_rates(spark),
    )
    rows = quality.expectation_suite(tagged).orderBy("position").collect()
    assert len(rows) == 12
    found = {(r.expectation.split("_to_")[1], r.column_name): r.unexpected_count for r in rows}
    assert found[("not_be_null", "transaction_id")] == 1
    assert found[("be_unique", "transaction_id")] == 2
    assert found[("be_between", "amount")] == 1
    assert found[("be_in_set", "currency")] == 1
    assert found[("not_be_null", "amount_pln")] == 1
    assert found[("be_in_set", "country")] == 0


def test_reports_by_run(spark, folder):
    profile = quality.quality_profile(silver_rows(spark, tx()), 0)
    assert reports.read_report(spark, folder, "quality_metrics", "a").isEmpty()
    reports.write_report(profile, folder, "quality_metrics", "a")
    reports.write_report(profile, folder, "quality_metrics", "b")
    reports.write_report(profile, folder, "quality_metrics", "b")
    runs = reports.read_report(spark, folder, "quality_metrics").select("run_id").collect()
    assert sorted(r.run_id for r in runs) == ["a", "b"]


@pytest.mark.parametrize("value", ['"many"', "1.5", "true", "-3"])
def test_a_damaged_report_file_fails_the_gate(spark, folder, value):
    text = json.dumps(METRICS).replace('"row_count": 1000', f'"row_count": {value}')
    line = spark.createDataFrame([(text,)], "value STRING")
    line.write.text(f"{folder}/quality_metrics/run=r")
    metrics = reports.read_report(spark, folder, "quality_metrics", "r")
    checks = spark.createDataFrame([("r", *c) for c in PASSED], QUALITY_CHECKS_DDL)
    assert [r.failure for r in quality.quality_gate(metrics, checks).collect()] == [
        quality.BAD_METRICS
    ]


@pytest.mark.parametrize(
    ("amount", "rate", "pln"),
    [(0.0049999999, "1.00", 0.0), (2.3249999995, "1.00", 2.32), (0.005, "1.00", 0.01), (100.0, "4.30", 430.0), (1e13, "1.00", None)],
)
def test_money_is_rounded_once(spark, amount, rate, pln):
    frame = spark.createDataFrame([(amount, rate)], "a DOUBLE, r STRING")
    assert frame.select(money.to_pln(frame.a, frame.r).alias("p")).first().p == pln


def test_a_profile_of_dirty_amounts_does_not_stop(spark):
    rows = silver.tagged_silver(bronze(spark, tx(), tx(amount=1e17), tx(amount=1e300)), fx_rates(spark))
    row = quality.quality_profile(rows, 0, "r").first()
    assert (row.row_count, row.amount_max) == (3, 1e300)
    wide = spark.createDataFrame([(1e17,), (2.0,), (1e30,)], "a DOUBLE")
    assert wide.select(money.mean(wide.a).alias("m")).first().m == 5e16 + 1
