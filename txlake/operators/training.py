"""Train the fraud model on labelled silver rows and keep it with its evidence."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import Bucketizer, VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txlake.constants import (
    BOOSTING_ROUNDS,
    FEATURE_NAMES,
    FRAUD_THRESHOLD,
    HOLDOUT_SHARE,
    MODEL_METADATA,
)
from txlake.operators.evaluation import ranking_quality
from txlake.operators.ordered import deciles, running_totals, value_at_rank
from txlake.operators.scoring import (
    Scorer,
    add_fraud_scores,
    heuristic_scorer,
    pipeline_scorer,
    with_features,
)
from txlake.sources import shared

#: Bins that trees see a number by, and the feature that has more values than that.
BINS = 32
AMOUNT, AMOUNT_BIN = "log_amount_pln", "log_amount_bin"
BINNED = tuple(AMOUNT_BIN if f == AMOUNT else f for f in FEATURE_NAMES)


def draw(key: str, seed: int = 42) -> Column:
    """A number in [0, 2^52) fixed by the key and the seed, as an exact double."""
    digest = F.md5(F.concat(F.col(key), F.lit(f"#{seed}")))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double")


def stratified_split(
    silver: DataFrame, label: str = "is_fraud_label", share: float = HOLDOUT_SHARE, seed: int = 42
) -> DataFrame:
    """Add ``is_holdout``: in each class the rows with the lowest draws, ``ceil(share * n)``.

    The cut per class is one order statistic from running totals, so a class
    holding nearly all rows is never sorted in one task.
    """
    rows = silver.filter(F.col(label).isNotNull()).withColumn("_draw", draw("transaction_id", seed))
    draws = rows.select(label, "_draw", F.lit(1).alias("n"))
    wanted = {"_last": F.ceil(F.col("total_n") * F.lit(share)) - 1}
    cuts = (
        running_totals(draws, "_draw", ["n"], by=[label], per_key=wanted)
        .groupBy(label)
        .agg(value_at_rank("_draw", "cum_n", F.col("_last")).alias("_cut"))
    )
    # two rows, one per class
    return (
        rows.join(F.broadcast(cuts), label)
        .withColumn("is_holdout", F.col("_draw") <= F.col("_cut"))
        .select(*silver.columns, "is_holdout")
    )


def amount_cuts(prepared: DataFrame) -> list[float]:
    """Values that cut the amounts of all rows into at most ``BINS`` bins of about equal size, each where its bin begins.

    Few distinct amounts have a bin each.
    """
    shares = [i / BINS for i in range(1, BINS)]
    found = prepared.agg(
        F.percentile_approx(AMOUNT, shares).alias("cuts"),
        F.approx_count_distinct(AMOUNT).alias("values"),
        F.min(AMOUNT).alias("least"),
    ).first()
    if found["least"] is None:
        return [0.0]
    cuts = set(found["cuts"])
    if found["values"] <= 2 * BINS:
        values = [r[0] for r in prepared.select(AMOUNT).distinct().collect()]  # some more than 2 * BINS at most
        cuts = set(values) if len(values) <= BINS else cuts
    return sorted(c for c in cuts if c == c and c > found["least"]) or [found["least"]]


def feature_counts(prepared: DataFrame, cuts: list[float], label: str = "label") -> DataFrame:
    """``BINNED`` features, ``label`` and ``n``: how many rows have them. Some ten thousand lines, whatever the table's size."""
    kept = ["label", *(f for f in BINNED if f != AMOUNT_BIN)]
    rows = _bucketizer(cuts).transform(prepared.withColumn("label", F.col(label).cast("double")))
    number = F.col(AMOUNT_BIN).cast("int").alias(AMOUNT_BIN)  # without the mark of a category
    return rows.groupBy(number, *kept).agg(F.count(F.lit(1)).cast("double").alias("n"))


def _bucketizer(cuts: list[float]) -> Bucketizer:
    # what is no number is in a bin behind all others
    bounds = [float("-inf"), *cuts, float("inf")]
    return Bucketizer(splits=bounds, inputCol=AMOUNT, outputCol=AMOUNT_BIN, handleInvalid="keep")


def fit_gbt(train_rows: DataFrame, label: str, seed: int = 42, rounds: int = BOOSTING_ROUNDS) -> PipelineModel:
    """Gradient-boosted trees over the seven features.

    The trees see amounts by ``BINS`` bins, as the library's do, so rows of equal bins,
    features and label are told apart by nothing: they are one line with a weight, and a
    round costs the same whatever the table's size.
    """
    prepared = with_features(train_rows).select(*FEATURE_NAMES, F.col(label).alias("label"))
    cuts = amount_cuts(prepared)
    counted = shared.stage(feature_counts(prepared, cuts), "counted")
    stages = [
        VectorAssembler(inputCols=list(BINNED), outputCol="features"),
        GBTClassifier(
            labelCol="label", featuresCol="features", weightCol="n", maxIter=rounds, maxDepth=3, maxBins=BINS, seed=seed
        ),
    ]
    try:
        fitted = Pipeline(stages=stages).fit(counted)
    finally:
        shared.discard(counted)
    return PipelineModel([_bucketizer(cuts), *fitted.stages])


def reference_distribution(scored_train: DataFrame, silver: DataFrame) -> DataFrame:
    """``feature, value, n`` rows the model keeps for drift: scores of the training side, amounts of all.

    Every row counts; equal rounded values share one line.
    """

    def part(df: DataFrame, feature: str, places: int) -> DataFrame:
        return df.select(F.lit(feature).alias("feature"), F.round(feature, places).alias("value"))

    cells = part(scored_train, "fraud_score", 6).unionByName(part(silver, "amount_pln", 2))
    return cells.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))


def train(
    spark: SparkSession,
    silver: DataFrame,
    path: str,
    label: str = "is_fraud_label",
    seed: int = 42,
    rounds: int = BOOSTING_ROUNDS,
    now: datetime | None = None,
) -> DataFrame:
    """Split, fit, evaluate and save; returns the one-row metadata.

    Everything downstream reads the staged split, so its rows cannot change
    between fitting and evaluation. ``now`` dates the record.
    """
    now = now or datetime.now(tz=UTC)
    split_path, scores_path = shared.fresh_path(spark, "split"), shared.fresh_path(spark, "scores")
    try:
        stratified_split(silver, label, seed=seed).write.parquet(split_path)
        split = spark.read.parquet(split_path)
        train_rows, holdout = split.filter("NOT is_holdout"), split.filter("is_holdout")
        model = fit_gbt(train_rows, label, seed, rounds)
        scorer = pipeline_scorer(model)
        add_fraud_scores(train_rows, scorer).select("transaction_id", "fraud_score").write.parquet(scores_path)
        scored_train = spark.read.parquet(scores_path)
        tested = ranking_quality(add_fraud_scores(holdout, scorer), "fraud_score", label).first()
        heuristic = ranking_quality(add_fraud_scores(holdout, heuristic_scorer()), "fraud_score", label).first()
        samples = split.agg(F.count(F.lit(1)).alias("n"), F.count_if(label).alias("fraud")).first()
        scores, amounts = (_listed(deciles(df, [f])) for df, f in ((scored_train, "fraud_score"), (split, "amount_pln")))
        shared.delete(spark, f"{path}/metadata")
        model.write().overwrite().save(f"{path}/model")
        reference = reference_distribution(scored_train, split)
        reference.write.mode("overwrite").parquet(f"{path}/reference")
    finally:
        shared.delete(spark, split_path)
        shared.delete(spark, scores_path)
    record = (
        scorer.kind, "GBTClassifier", list(FEATURE_NAMES), FRAUD_THRESHOLD, now.replace(microsecond=0).isoformat(),
        samples["n"], samples["fraud"], round(tested["roc_auc"], 4), round(tested["average_precision"], 4),
        round(heuristic["average_precision"], 4), round(tested["no_skill"], 4), tested["rows"], (scores, amounts),
    )
    # Written last: a folder without metadata is not a usable model.
    row = spark.createDataFrame([record], MODEL_METADATA)
    row.coalesce(1).write.mode("overwrite").json(f"{path}/metadata")
    return spark.read.schema(MODEL_METADATA).json(f"{path}/metadata")


def _listed(decile_rows: DataFrame) -> list[float]:
    """Eleven values, as the metadata keeps them."""
    return [row["value"] for row in decile_rows.orderBy("decile").collect()]


def load_model(spark: SparkSession, path: str) -> Scorer:
    """A saved model with its threshold and reference distribution."""
    metadata = spark.read.schema(MODEL_METADATA).json(f"{path}/metadata").first()
    if metadata is None or metadata["threshold"] is None:
        raise ValueError(f"no readable metadata at {path}")
    reference = spark.read.parquet(f"{path}/reference")
    return pipeline_scorer(PipelineModel.load(f"{path}/model"), metadata["threshold"], reference)
