"""Fraud scoring with a native expression, a Spark ML model or a vectorised UDF."""

import logging
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Any

import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txlake.constants import FEATURE_NAMES, FRAUD_THRESHOLD
from txlake.functions.signals import feature_columns, heuristic_score
from txlake.sources import shared

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Scorer:
    """Adds ``fraud_score`` to a silver frame; knows its threshold and reference sample."""

    kind: str
    score: Callable[[DataFrame], DataFrame]
    threshold: float = FRAUD_THRESHOLD
    reference: DataFrame | None = None


def heuristic_scorer(threshold: float = FRAUD_THRESHOLD) -> Scorer:
    """Column expression only: no Python worker, no shuffle."""
    return Scorer("heuristic", lambda df: df.withColumn("fraud_score", heuristic_score()), threshold)


def with_features(silver: DataFrame) -> DataFrame:
    """Silver rows plus the seven model inputs."""
    return silver.withColumns(feature_columns())


def features(silver: DataFrame) -> DataFrame:
    """``transaction_id`` and the seven model inputs."""
    columns = feature_columns()
    return silver.select("transaction_id", *[c.alias(n) for n, c in columns.items()])


def pipeline_scorer(
    model: PipelineModel,
    threshold: float = FRAUD_THRESHOLD,
    reference: DataFrame | None = None,
) -> Scorer:
    def score(df: DataFrame) -> DataFrame:
        predicted = model.transform(with_features(df))
        fraud = F.get(vector_to_array("probability"), F.lit(1))
        return predicted.select(*[F.col(c) for c in df.columns], fraud.alias("fraud_score"))

    return Scorer("spark_ml", score, threshold, reference)


def pandas_scorer(
    load: Callable[[], Any], threshold: float = FRAUD_THRESHOLD, kind: str = "pandas"
) -> Scorer:
    """Any model with ``score(features_frame)``, applied to Arrow batches.

    ``load`` runs once per task; it must be importable by the workers or
    serialisable. Features are made as columns first, so no timestamp crosses
    to Python and the hour cannot shift with the zone.
    """
    names = list(FEATURE_NAMES)

    def apply_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        model = load()
        for batch in batches:
            if batch.empty:
                yield pd.Series([], dtype="float64")
            else:
                yield pd.Series(model.score(batch[names]), dtype="float64")

    apply_model = F.pandas_udf(apply_batches, "double")

    def score(df: DataFrame) -> DataFrame:
        inputs = F.struct(*[c.alias(n) for n, c in feature_columns().items()])
        return df.withColumn("fraud_score", apply_model(inputs))

    return Scorer(kind, score, threshold)


def add_fraud_scores(
    silver: DataFrame, scorer: Scorer | None = None, threshold: float | None = None
) -> DataFrame:
    """Silver rows with ``fraud_score`` and ``fraud_flag``.

    ``threshold=None`` uses the scorer's own.
    """
    scorer = scorer or heuristic_scorer()
    limit = scorer.threshold if threshold is None else threshold
    return scorer.score(silver).withColumn("fraud_flag", F.col("fraud_score") >= limit)


def load_or_default(spark: SparkSession, path: str | None) -> Scorer:
    """The trained model at ``path``; the heuristic when there is none or it can't be used.

    Scoring goes on whatever the reason is; the reason is logged.
    """
    from txlake.operators.training import load_model

    if path is None or not shared.child_names(spark, path):
        return heuristic_scorer()
    try:
        return load_model(spark, path)
    except Exception as error:  # noqa: BLE001 - a damaged model may fail in any way
        reason = (str(error).splitlines() or [""])[0]
        log.warning("model at %s is unusable (%s: %s); scoring by the heuristic", path, type(error).__name__, reason)
        return heuristic_scorer()
