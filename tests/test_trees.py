"""Boosted trees as column expressions next to their pipeline."""

from __future__ import annotations

import random

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tests.build import silver_rows, tx
from txlake.constants import FEATURE_NAMES
from txlake.operators import scoring, training, trees
from txlake.sources import shared


@pytest.fixture(scope="module")
def rows(spark):
    drawn = random.Random(4)
    made = [
        tx(
            transaction_id=f"t{i}",
            timestamp=f"2026-06-13T{drawn.randrange(24):02d}:00:00+00:00",
            amount=round(drawn.lognormvariate(4, 2), 2) + 0.01,
            merchant_category=drawn.choice(["grocery", "gambling", "travel"]),
            country=drawn.choice(["PL", "DE", "CN"]),
            channel=drawn.choice(["POS", "ONLINE", "ATM"]),
            is_fraud_label=i % 3 == 0 or drawn.random() < 0.1,
        )
        for i in range(400)
    ]
    return shared.stage(silver_rows(spark, *made), "rows")


def test_scores_equal_the_pipelines(spark, rows):
    model = training.fit_gbt(rows, "is_fraud_label", rounds=12)
    named = rows.withColumn("hour", F.lit("x")).withColumn("_row", F.lit(1))  # columns that features are called by
    by_pipeline = scoring.pipeline_scorer(model).score(rows).select("transaction_id", F.col("fraud_score").alias("expected"))
    scored = scoring.add_fraud_scores(named, trees.expression_scorer(model, 0.4))
    assert scored.columns == [*named.columns, "fraud_score", "fraud_flag"]
    both = scored.join(by_pipeline, "transaction_id").collect()
    assert len(both) == 400 and len({r.expected for r in both}) > 20
    assert all(abs(r.fraud_score - r.expected) < 1e-9 and r.fraud_flag == (r.fraud_score >= 0.4) for r in both)


def test_scoring_stays_in_the_row(spark, rows):
    model = training.fit_gbt(rows, "is_fraud_label", rounds=3)
    plan = trees.expression_scorer(model).score(rows)._jdf.queryExecution().executedPlan().toString()
    assert "UDF" not in plan and "Exchange" not in plan


def test_other_pipelines_are_refused(spark, rows):
    prepared = scoring.with_features(rows).withColumn("label", F.col("is_fraud_label").cast("double"))
    stages = [VectorAssembler(inputCols=list(FEATURE_NAMES), outputCol="features"), LogisticRegression(maxIter=1)]
    with pytest.raises(ValueError, match="gradient-boosted"):
        trees.expression_scorer(Pipeline(stages=stages).fit(prepared))


def test_trees_are_fitted_on_as_many_lines_however_often_rows_repeat(spark, rows):
    prepared = scoring.with_features(rows)
    often = prepared.crossJoin(spark.range(5))
    cuts = training.amount_cuts(prepared)
    assert 16 <= len(cuts) < training.BINS and cuts == sorted(set(cuts))
    once, many = (training.feature_counts(df, cuts, "is_fraud_label") for df in (prepared, often))
    assert once.count() == many.count() < 400
    assert (once.agg(F.sum("n")).first()[0], many.agg(F.sum("n")).first()[0]) == (400, 2000)


def test_few_amounts_have_a_bin_each(spark, rows):
    prepared = scoring.with_features(rows).withColumn(training.AMOUNT, F.when(F.col("transaction_id").endswith("7"), 2.0).otherwise(1.0))
    assert training.amount_cuts(prepared) == [2.0]
    assert training.amount_cuts(prepared.withColumn(training.AMOUNT, F.lit(3.0))) == [3.0]
    assert training.amount_cuts(prepared.limit(0)) == [0.0]
