from __future__ import annotations

import math

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.build import silver_rows, tx
from txlake.constants import GOLD_TABLES, HEURISTIC_WEIGHTS
from txlake.functions.signals import psi_band
from txlake.operators import gold, scoring
from txlake.plans import serving

RISKY = tx(
    transaction_id="risky",
    timestamp="2026-06-13T23:30:00+00:00",
    amount=9000.0,
    country="US",
    merchant_category="gambling",
    channel="ONLINE",
)


def test_signals_of_a_risky_and_a_benign_row(spark):
    rows = gold.fraud_signals(silver_rows(spark, tx(), RISKY)).collect()
    assert {r.transaction_id: r.signal_count for r in rows} == {"t1": 0, "risky": 5}


def test_high_amount_is_a_setting(spark):
    row = gold.fraud_signals(silver_rows(spark, tx()), high_amount_pln=100.0).first()
    assert row.signal_high_amount


def test_velocity_counts_equal_plain_distinct_counts(spark):
    records = [
        tx(transaction_id=f"t{i}", device_id=f"D{i % 7}", country=c, merchant_category=m)
        for i, (c, m) in enumerate(
            (c, m) for c in ("PL", "DE", "US") for m in ("fuel", "health", "travel", "fuel")
        )
    ]
    rows = silver_rows(spark, *records)
    closed = gold.account_velocity(rows).collect()
    assert closed == gold.account_velocity(rows, closed_vocabularies=False).collect()
    assert (closed[0].distinct_countries, closed[0].distinct_categories) == (3, 3)
    assert "Expand" not in gold.account_velocity(rows)._jdf.queryExecution().executedPlan().toString()


def test_a_word_outside_the_vocabulary_is_not_miscounted(spark):
    rows = silver_rows(spark, tx()).withColumn("country", F.lit("XX"))
    with pytest.raises(Exception, match="outside its vocabulary"):
        gold.account_velocity(rows).collect()
    assert gold.account_velocity(rows, closed_vocabularies=False).first().distinct_countries == 1


def test_missing_values_in_features(spark):
    row = (
        silver_rows(spark, tx())
        .withColumns({c: F.lit(None).cast(t) for c, t in (
            ("amount_pln", "double"), ("event_time", "timestamp"), ("channel", "string"),
            ("merchant_category", "string"), ("country", "string"))})
        .transform(scoring.features)
        .first()
    )
    assert (row.log_amount_pln, row.hour, row.is_night) == (0.0, 0.0, 1.0)
    assert (row.is_online, row.is_atm, row.is_high_risk_category, row.is_foreign) == (0, 0, 0, 1)


def test_heuristic_score_by_hand_and_threshold(spark):
    rows = silver_rows(spark, tx(), RISKY)
    scored = {r.transaction_id: r for r in scoring.add_fraud_scores(rows).collect()}
    z = -4.2 + 0.25 * math.log1p(9000.0 * 1.0) + 0.4 + 1.0 + 1.3 + 0.9
    assert scored["risky"].fraud_score == pytest.approx(1 / (1 + math.exp(-z)))
    assert scored["risky"].fraud_flag and not scored["t1"].fraud_flag
    strict = scoring.add_fraud_scores(rows, threshold=0.999).filter("fraud_flag").count()
    assert strict == 0


def test_a_pandas_model_equals_the_expression(spark):
    class Model:
        def score(self, frame):
            z = -4.2 + sum(w * frame[n] for n, w in HEURISTIC_WEIGHTS.items())
            return 1 / (1 + (-z).apply(math.exp))

    rows = silver_rows(spark, tx(), RISKY)
    native = scoring.add_fraud_scores(rows).orderBy("transaction_id").toPandas()
    python = scoring.add_fraud_scores(rows, scoring.pandas_scorer(Model)).orderBy("transaction_id").toPandas()
    pd.testing.assert_frame_equal(native, python, rtol=1e-9)
    nothing = scoring.add_fraud_scores(rows.filter("false"), scoring.pandas_scorer(Model))
    assert nothing.count() == 0


@pytest.mark.parametrize(
    "psi, band",
    [(0.0, "stable"), (0.0999, "stable"), (0.1, "moderate"), (0.2, "significant"), (5.0, "significant")],
)
def test_bands(spark, psi, band):
    assert spark.range(1).select(psi_band(F.lit(psi))).first()[0] == band


def test_serving_over_empty_gold_is_zero(spark, folder):
    nothing = silver_rows(spark, tx()).filter("false")
    builders = dict(zip(GOLD_TABLES, (
        gold.daily_volume_by_country, gold.merchant_category_kpi, gold.account_velocity,
        gold.fraud_signals, scoring.add_fraud_scores), strict=True))
    for name, build in builders.items():
        build(nothing).write.parquet(f"{folder}/{name}")
    kpi = serving.serve(spark, "kpi_row", folder).first()
    assert tuple(kpi) == (0, 0.0, 0, 0)
    assert serving.serve(spark, "fraud_headline", folder).first().fraud_rate == 0.0
    assert serving.serve(spark, "q1_top_countries", folder).count() == 0


def test_serving_a_missing_table_is_an_error(spark, folder):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        serving.serve(spark, "kpi_row", folder)
