from __future__ import annotations

import math
from bisect import bisect_right

import numpy as np
import pandas as pd
import pytest

from txlake.operators import drift, evaluation, ordered
from txlake.schemas import DRIFT_METRICS_DDL


def column(spark, values):
    return spark.createDataFrame(pd.DataFrame({"x": np.asarray(values, dtype="float64")}))


def empty(spark):
    return spark.createDataFrame([], "x DOUBLE")


def figures(spark, reference, live):
    frames = [column(spark, v) if len(v) else empty(spark) for v in (reference, live)]
    return drift.feature_drift(*frames, ["x"]).first()


def direct_psi(reference, live):
    """The index from sorted lists, for comparison."""
    r, n = sorted(reference), len(reference)
    edges = [r[min(n - 1, round(i / 10 * (n - 1)))] for i in range(10)] + [r[-1]]
    for i in range(1, 11):
        if edges[i] <= edges[i - 1]:
            edges[i] = edges[i - 1] + 1e-6
    total = 0.0
    inner = edges[1:10]
    for b in range(10):
        p = max(sum(sum(v > e for e in inner) == b for v in reference) / n, 1e-6)
        q = max(sum(sum(v > e for e in inner) == b for v in live) / len(live), 1e-6)
        total += (q - p) * math.log(q / p)
    return total


def direct_ks(a, b):
    a, b = sorted(a), sorted(b)
    return max(abs(bisect_right(a, x) / len(a) - bisect_right(b, x) / len(b)) for x in a + b)


rng = np.random.default_rng(3)
NORMAL = rng.normal(0, 1, 800)


@pytest.mark.parametrize(
    "reference, live",
    [
        (NORMAL, rng.normal(0.3, 1.2, 500)),
        (np.r_[np.zeros(300), rng.exponential(5, 500).round(1)], rng.exponential(4, 400).round(1)),
        (np.full(50, 7.0), [7.0, 7.0, 8.0, 1.0]),
        ([3.0], [1.0, 5.0]),
    ],
)
def test_figures_equal_a_direct_computation(spark, reference, live):
    row = figures(spark, reference, live)
    assert row.psi == pytest.approx(direct_psi(list(reference), list(live)), abs=1e-9)
    assert row.ks == pytest.approx(direct_ks(list(reference), list(live)), abs=1e-12)
    assert (row.reference_n, row.live_n) == (len(reference), len(live))


def test_identical_shifted_and_disjoint(spark):
    same = figures(spark, NORMAL, NORMAL)
    assert same.psi < 1e-6 and same.ks == 0
    assert figures(spark, NORMAL, NORMAL + 3).psi > 0.25
    assert figures(spark, [1.0, 2.0], [8.0, 9.0]).ks == 1.0


@pytest.mark.parametrize("reference, live", [([], [1.0]), ([1.0], []), ([], [])])
def test_an_empty_side_is_zero(spark, reference, live):
    row = figures(spark, reference, live)
    assert (row.psi, row.ks, row.reference_n, row.live_n) == (0.0, 0.0, len(reference), len(live))


def test_a_long_reference_table_works_like_a_wide_one(spark):
    wide = column(spark, NORMAL)
    long = wide.selectExpr("'x' AS feature", "x AS value")
    live = column(spark, NORMAL + 0.5)
    assert drift.feature_drift(long, live, ["x"]).first() == drift.feature_drift(wide, live, ["x"]).first()


def test_running_totals_with_a_hot_value_and_odd_values(spark):
    hot = [5.0] * 2000
    values = hot + list(rng.normal(0, 50, 3000)) + [float("inf"), float("-inf"), -0.0, 0.0]
    frame = column(spark, values).selectExpr("x", "1 AS n")
    got = ordered.running_totals(frame, "x", ["n"], chunks=16).orderBy("x").toPandas()
    want = pd.Series(values).add(0.0).value_counts().sort_index()
    assert got["n"].tolist() == want.tolist()
    assert got["cum_n"].tolist() == want.cumsum().tolist()
    assert (got["total_n"] == len(values)).all()


def test_running_totals_sort_in_many_tasks(spark):
    frame = column(spark, NORMAL).selectExpr("x", "1 AS n")
    plan = ordered.running_totals(frame, "x", ["n"])._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(_chunk" in plan


def test_deciles_equal_numpy(spark):
    rows = ordered.deciles(column(spark, NORMAL), ["x"]).orderBy("decile").collect()
    want = np.quantile(NORMAL, np.arange(11) / 10)
    assert [r.value for r in rows] == pytest.approx(want.tolist(), abs=1e-6)


def test_ranking_quality_with_ties(spark):
    scores = rng.integers(0, 12, 400) / 12
    labels = rng.random(400) < scores * 0.5
    frame = spark.createDataFrame(pd.DataFrame({"s": scores, "y": labels}))
    row = evaluation.ranking_quality(frame, "s", "y").first()
    pos, neg = scores[labels], scores[~labels]
    wins = sum((p > neg).sum() + 0.5 * (p == neg).sum() for p in pos)
    precision = 0.0
    for cut in sorted(set(scores), reverse=True):
        gain = (pos == cut).sum() / len(pos)
        precision += gain * (pos >= cut).sum() / (scores >= cut).sum()
    assert row.roc_auc == pytest.approx(wins / (len(pos) * len(neg)))
    assert row.average_precision == pytest.approx(precision)
    assert row.no_skill == pytest.approx(labels.mean())


def test_one_class_has_no_auc(spark):
    frame = spark.createDataFrame([(0.5, True), (0.7, True)], "s DOUBLE, y BOOLEAN")
    assert evaluation.ranking_quality(frame, "s", "y").first().roc_auc is None


def decide(spark, *metrics, **policy):
    report = spark.createDataFrame(list(metrics), DRIFT_METRICS_DDL)
    runs = spark.createDataFrame([("r",)], "run_id STRING")
    return drift.decide_retraining(runs, report, **policy).first()


def line(feature="fraud_score", psi=0.3, band="significant", ref=5000, live=5000):
    return ("r", feature, psi, band, 0.1, ref, live)


@pytest.mark.parametrize(
    "metrics, verdict, reason",
    [
        ([line()], "RETRAIN", "drift_over_threshold"),
        ([line(band="moderate", psi=0.15)], "NO_RETRAIN", "within_limits"),
        ([line(ref=0)], "NO_RETRAIN", "nothing_comparable"),
        ([line(ref=None)], "NO_RETRAIN", "nothing_comparable"),
        ([line(live=12)], "NO_RETRAIN", "nothing_comparable"),
        ([line(live=199), line("amount_pln", 0.01, "stable")], "NO_RETRAIN", "within_limits"),
        ([line(ref=0), line("amount_pln")], "RETRAIN", "drift_over_threshold"),
        ([], "NO_RETRAIN", "no_metrics"),
    ],
)
def test_policy(spark, metrics, verdict, reason):
    row = decide(spark, *metrics)
    assert (row.verdict, row.reason) == (verdict, reason)
    assert row.should_retrain == (verdict == "RETRAIN")


def test_policy_settings_and_evidence(spark):
    row = decide(spark, line(band="moderate", psi=0.15), trigger_bands=("moderate",))
    assert row.triggered_by == "fraud_score (PSI=0.15, moderate)"
    assert decide(spark, line(live=12), min_live_samples=10).verdict == "RETRAIN"
    assert decide(spark, line(live=12)).not_comparable == "fraud_score (only 12 rows, need 200)"


def test_roc_auc_of_counts_whose_product_is_no_long(spark, monkeypatch):
    """Four thousand million positives at one score above three thousand million negatives."""
    totals = spark.createDataFrame(
        [(0.1, 0, 3 * 10**9, 0, 3 * 10**9), (0.9, 4 * 10**9, 0, 4 * 10**9, 3 * 10**9)],
        "score DOUBLE, pos BIGINT, neg BIGINT, cum_pos BIGINT, cum_neg BIGINT",
    ).selectExpr("*", "4000000000L AS total_pos", "3000000000L AS total_neg")
    monkeypatch.setattr(evaluation, "running_totals", lambda *args, **more: totals)
    row = evaluation.ranking_quality(spark.createDataFrame([(0.1, True)], "s DOUBLE, y BOOLEAN"), "s", "y").first()
    assert row.roc_auc == 1.0 and row.rows == 7 * 10**9


def test_several_runs_in_one_pass_equal_single_ones(spark):
    drawn = np.random.default_rng(3)
    sides = {run: (drawn.normal(size=400), drawn.normal(shift, 1, 300)) for run, shift in (("a", 0), ("b", 2))}
    sides["c"] = (np.array([]), sides["a"][1])

    def wide(side):
        rows = [(run, float(v)) for run, pair in sides.items() for v in pair[side]]
        return spark.createDataFrame(rows, "run_id STRING, x DOUBLE")

    runs = spark.createDataFrame([("a",), ("b",), ("c",), ("none",)], "run_id STRING")
    found = {r.run_id: r for r in drift.feature_drift(wide(0), wide(1), ["x"], runs=runs).collect()}
    for run, (reference, live) in sides.items():
        one = figures(spark, reference, live)
        for name in ("psi", "ks", "reference_n", "live_n"):
            assert found[run][name] == pytest.approx(one[name])
    assert (found["none"].psi, found["none"].live_n) == (0.0, 0)


def test_a_weighted_reference_equals_its_rows(spark):
    values = [1.0, 1.0, 2.0, 5.0, 5.0, 5.0, 9.0] * 20
    long = spark.createDataFrame([("x", v, values.count(v)) for v in set(values)], "feature STRING, value DOUBLE, n BIGINT")
    live = column(spark, [2.0, 5.0, 7.0] * 50)
    assert drift.feature_drift(long, live, ["x"]).first() == drift.feature_drift(column(spark, values), live, ["x"]).first()


def test_running_totals_of_many_keys_need_no_broadcast(spark):
    rows = spark.range(2000).selectExpr("id % 500 AS k", "CAST(id AS DOUBLE) AS v", "1 AS n")
    few, many = (ordered.running_totals(rows, "v", ["n"], by=["k"], few_keys=f) for f in (True, False))
    assert few.exceptAll(many).isEmpty() and few.count() == many.count() == 2000
    assert many.where("cum_n = 4 AND total_n = 4").count() == 500
