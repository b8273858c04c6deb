"""A trained forest as one column expression.

Trees become nested conditions over the feature columns, so scoring stays in generated
code: no vectors are built and nothing leaves the row.
"""

from __future__ import annotations

import math
from functools import reduce
from operator import add

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.feature import Bucketizer, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txlake.constants import FRAUD_THRESHOLD
from txlake.functions.signals import feature_columns
from txlake.operators.scoring import Scorer


def _at_most(name: str, threshold: float, bins: dict[str, Bucketizer]) -> Column:
    """Whether a feature is at or below a threshold; of a bin's number, whether its value lies below where the next begins."""
    if name not in bins:
        return F.col(name) <= F.lit(threshold)
    return F.col(bins[name].getInputCol()) < F.lit(bins[name].getSplits()[math.floor(threshold) + 1])


def _tree(node, names: list[str], bins: dict[str, Bucketizer]) -> Column:
    """A node of a fitted tree: rows at or below the threshold of its split go left."""
    if node.subtreeDepth() == 0:
        return F.lit(float(node.prediction()))
    split = node.split()
    if "ContinuousSplit" not in split.getClass().getName():
        raise ValueError("only splits at a threshold can be written as a condition")
    left, right = _tree(node.leftChild(), names, bins), _tree(node.rightChild(), names, bins)
    return F.when(_at_most(names[split.featureIndex()], float(split.threshold()), bins), left).otherwise(right)


def gbt_probability(model: PipelineModel) -> Column:
    """The probability of class 1 over the columns that the pipeline assembles, or that it assembles the bins of.

    The weighted sum of the trees is half the log odds, as the library has it.
    """
    assembler = next((s for s in model.stages if isinstance(s, VectorAssembler)), None)
    forest = next((s for s in model.stages if isinstance(s, GBTClassificationModel)), None)
    bins = {s.getOutputCol(): s for s in model.stages if isinstance(s, Bucketizer)}
    if assembler is None or forest is None or len(model.stages) != 2 + len(bins):
        raise ValueError("expected a pipeline of bins, if any, an assembler and gradient-boosted trees")
    names = assembler.getInputCols()
    parts = [F.lit(float(w)) * _tree(t._java_obj.rootNode(), names, bins) for t, w in zip(forest.trees, forest.treeWeights, strict=True)]
    return F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(-2.0) * reduce(add, parts)))


def expression_scorer(
    model: PipelineModel, threshold: float = FRAUD_THRESHOLD, reference: DataFrame | None = None
) -> Scorer:
    """Like ``scoring.pipeline_scorer`` for gradient-boosted trees, without vectors."""
    probability = gbt_probability(model)
    inputs = feature_columns()

    def score(df: DataFrame) -> DataFrame:
        # a row may have a column of a feature's name
        kept = df.select(F.struct("*").alias("_row"), *[c.alias(n) for n, c in inputs.items()])
        return kept.select("_row.*", probability.alias("fraud_score"))

    return Scorer("gbt_expression", score, threshold, reference)
