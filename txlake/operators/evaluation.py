"""Ranking quality of a score against a boolean label."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txlake.operators.ordered import running_totals


def ranking_quality(scored: DataFrame, score: str, label: str) -> DataFrame:
    """One row: ``rows, positives, no_skill, roc_auc, average_precision``.

    ROC-AUC counts ties half. Average precision adds precision times the gain
    in recall at each distinct score, which differs from the area under a
    trapezoid curve.
    """
    sides = scored.filter(F.col(label).isNotNull()).select(
        F.col(score).alias("score"),
        F.col(label).cast("int").alias("pos"),
        (1 - F.col(label).cast("int")).alias("neg"),
    )

    def wide(count: Column) -> Column:
        """Products of two counts don't fit a long."""
        return count.cast("decimal(18,0)")

    totals = running_totals(sides, "score", ["pos", "neg"])
    pos, neg = F.col("pos"), F.col("neg")
    caught = F.col("total_pos") - F.col("cum_pos") + pos
    alarms = F.col("total_neg") - F.col("cum_neg") + neg
    below = F.col("cum_neg") - neg
    positives, negatives = F.max("total_pos"), F.max("total_neg")
    both = F.nullif(positives.cast("double") * negatives, F.lit(0.0))
    return totals.agg(
        (positives + negatives).alias("rows"),
        positives.alias("positives"),
        (positives / (positives + negatives)).alias("no_skill"),
        (F.sum(wide(pos) * (wide(below) + wide(below) + wide(neg))).cast("double") / 2 / both).alias("roc_auc"),
        (F.sum(pos * (caught / (caught + alarms))) / F.nullif(positives, F.lit(0))).alias(
            "average_precision"
        ),
    )
