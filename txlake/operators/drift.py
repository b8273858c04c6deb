"""Population stability index, Kolmogorov-Smirnov distance and the retraining decision."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txlake.constants import (
    DRIFT_FEATURES,
    MIN_LIVE_SAMPLES,
    PSI_BUCKETS,
    PSI_EPSILON,
    RETRAIN_BANDS,
)
from txlake.functions.signals import psi_band
from txlake.operators.ordered import running_totals, unpivoted, value_at_rank


def reference_cells(reference: DataFrame, features: Sequence[str]) -> DataFrame:
    """``feature, value, n`` rows of a wide frame, or of a long table such as a model's own (``n`` may lack: 1)."""
    if {"feature", "value"} <= set(reference.columns):
        weight = F.col("n") if "n" in reference.columns else F.lit(1)
        kept = reference.filter(F.col("feature").isin(list(features)))
        return kept.select("feature", "value", weight.cast("long").alias("n"))
    return unpivoted(reference, features, F.lit(1).cast("long").alias("n"))


def _both_sides(
    reference: DataFrame, live: DataFrame, features: Sequence[str], by: Sequence[str] = ()
) -> DataFrame:
    none, one = F.lit(0).cast("long"), F.lit(1).cast("long")

    def cells(side: DataFrame) -> DataFrame:
        return unpivoted(side, features, *by).withColumn("n", one) if by else reference_cells(side, features)

    expected = cells(reference).select(*by, "feature", "value", F.col("n").alias("ref"), none.alias("live"))
    actual = cells(live).select(*by, "feature", "value", none.alias("ref"), F.col("n").alias("live"))
    return expected.unionByName(actual).filter(F.col("value").isNotNull())


def _strictly_rising(edges: Column) -> Column:
    """Lift an edge that is not above the one before it by a small step."""
    start = F.array().cast("array<double>")

    def lift(done: Column, edge: Column) -> Column:
        before = F.element_at(done, -1)
        lifted = F.when((F.size(done) > 0) & (edge <= before), before + PSI_EPSILON).otherwise(edge)
        return F.array_append(done, lifted)

    return F.aggregate(edges, start, lift)


def _ranked(both: DataFrame, buckets: int, by: Sequence[str] = ()) -> DataFrame:
    """Running totals of both sides, with the ranks of the reference's quantile edges."""
    last = F.col("total_ref") - 1
    ranks = {
        f"_rank{i}": F.least(last, F.bround(F.lit(i / buckets) * last)) for i in range(buckets)
    }
    return running_totals(both, "value", ["ref", "live"], by=[*by, "feature"], per_key=ranks)


def _feature_shape(totals: DataFrame, buckets: int, by: Sequence[str] = ()) -> DataFrame:
    """Per feature: sizes, KS distance and the reference's quantile edges."""
    picks = [value_at_rank("value", "cum_ref", F.col(f"_rank{i}")) for i in range(buckets)]
    highest = F.max(F.when(F.col("ref") > 0, F.col("value")))
    gap = F.abs(
        F.col("cum_ref") / F.nullif("total_ref", F.lit(0))
        - F.col("cum_live") / F.nullif("total_live", F.lit(0))
    )
    return totals.groupBy(*by, "feature").agg(
        F.max("total_ref").alias("reference_n"),
        F.max("total_live").alias("live_n"),
        F.max(gap).alias("ks"),
        F.array(*picks, highest).alias("edges"),
    ).withColumn("edges", _strictly_rising(F.col("edges")))


def feature_drift(
    reference: DataFrame,
    live: DataFrame,
    features: Sequence[str] = DRIFT_FEATURES,
    buckets: int = PSI_BUCKETS,
    runs: DataFrame | None = None,
) -> DataFrame:
    """``feature, psi, ks, reference_n, live_n`` over all rows of both sides.

    All features go through one set of shuffles. A side may be a long table of ``feature,
    value, n``, as a model keeps its reference and ``states`` its histograms. ``runs`` lists the keys (say
    ``run_id``) of several comparisons at once: both sides then are wide frames with
    these columns, and so is the result. An empty side gives PSI and KS of 0; the
    retraining decision treats it as not comparable.
    """
    by = [] if runs is None else runs.columns
    totals = _ranked(_both_sides(reference, live, features, by), buckets, by)
    # One row per feature, so joining it is a map over the distinct values; its figures ride along
    # as grouping keys. Both uses of the totals read the same shuffled sums.
    shape = F.broadcast(_feature_shape(totals, buckets, by))
    above = [(F.col("value") > F.get("edges", F.lit(i))).cast("int") for i in range(1, buckets)]
    figures = (*by, "feature", "ks", "reference_n", "live_n")
    counted = (
        totals.select(*by, "feature", "value", "ref", "live")
        .join(shape, [*by, "feature"])
        .groupBy(*figures, reduce(add, above, F.lit(0)).alias("bucket"))
        .agg(F.sum("ref").alias("ref"), F.sum("live").alias("live"))
    )

    def share(count: str, total: str) -> Column:
        return F.greatest(F.col(count) / F.nullif(total, F.lit(0)), F.lit(PSI_EPSILON))

    expected, actual = share("ref", "reference_n"), share("live", "live_n")
    term = F.when(
        (F.col("reference_n") > 0) & (F.col("live_n") > 0),
        (actual - expected) * F.log(actual / expected),
    )
    measured = counted.groupBy(*figures).agg(F.sum(term).alias("psi"))
    asked = F.explode(F.array(*[F.lit(f) for f in features])).alias("feature")
    keys = live.sparkSession.range(1).select() if runs is None else runs
    return keys.select(*by, asked).join(measured, [*by, "feature"], "left").select(
        *by,
        "feature",
        F.coalesce("psi", F.lit(0.0)).alias("psi"),
        F.coalesce("ks", F.lit(0.0)).alias("ks"),
        F.coalesce("reference_n", F.lit(0)).cast("long").alias("reference_n"),
        F.coalesce("live_n", F.lit(0)).cast("long").alias("live_n"),
    )


def population_stability_index(
    reference: DataFrame, live: DataFrame, feature: str, buckets: int = PSI_BUCKETS
) -> DataFrame:
    return feature_drift(reference, live, [feature], buckets).select("feature", "psi")


def ks_statistic(reference: DataFrame, live: DataFrame, feature: str) -> DataFrame:
    """Largest gap between the two empirical distribution functions."""
    shape = _feature_shape(_ranked(_both_sides(reference, live, [feature]), PSI_BUCKETS), PSI_BUCKETS)
    return shape.select("feature", F.coalesce("ks", F.lit(0.0)).alias("ks"))


def drift_report(
    reference: DataFrame,
    live: DataFrame,
    features: Sequence[str] = DRIFT_FEATURES,
    run_id: str = "run",
    runs: DataFrame | None = None,
) -> DataFrame:
    """Report rows, one per feature: PSI with its band, KS and both sample sizes.

    ``runs`` (column ``run_id``) reports several runs in one pass, see ``feature_drift``.
    """
    return feature_drift(reference, live, features, runs=runs).select(
        F.lit(run_id).alias("run_id") if runs is None else F.col("run_id"),
        "feature",
        F.round("psi", 5).alias("psi"),
        psi_band(F.col("psi")).alias("psi_band"),
        F.round("ks", 5).alias("ks"),
        "reference_n",
        "live_n",
    )


def live_sample(scored: DataFrame, n: int, key: str = "transaction_id") -> DataFrame:
    """At most ``n`` rows, picked by a hash of the key: the same whatever the partitioning."""
    return scored.orderBy(F.md5(key), key).limit(n)


def decide_retraining(
    runs: DataFrame,
    report: DataFrame,
    trigger_bands: Sequence[str] = RETRAIN_BANDS,
    min_live_samples: int = MIN_LIVE_SAMPLES,
) -> DataFrame:
    """Verdict per run of ``runs`` (column ``run_id``); a run without a report stays closed.

    Features without a reference or with too few live rows carry no evidence.
    """
    reference_n = F.coalesce("reference_n", F.lit(0))
    live_n = F.coalesce("live_n", F.lit(0))
    gap = F.when(reference_n == 0, F.concat("feature", F.lit(" (no reference)"))).when(
        live_n < min_live_samples,
        F.concat(
            "feature",
            F.lit(" (only "),
            live_n.cast("string"),
            F.lit(f" rows, need {min_live_samples})"),
        ),
    )
    drifted = F.when(
        gap.isNull() & F.col("psi_band").isin(list(trigger_bands)),
        F.concat(
            "feature", F.lit(" (PSI="), F.col("psi").cast("string"), F.lit(", "), "psi_band", F.lit(")")
        ),
    )
    judged = report.filter(F.col("feature").isNotNull()).select(
        "run_id", gap.alias("gap"), drifted.alias("drifted")
    )
    # Sets of report lines, one per monitored column: bounded by the report's width.
    by_run = judged.groupBy("run_id").agg(
        F.count_if(F.col("gap").isNull()).alias("comparable"),
        F.array_sort(F.collect_set("drifted")).alias("drifted"),
        F.array_sort(F.collect_set("gap")).alias("gaps"),
    )
    retrain = F.coalesce(F.size("drifted") > 0, F.lit(False))
    return runs.join(by_run, "run_id", "left").select(
        "run_id",
        F.when(retrain, "RETRAIN").otherwise("NO_RETRAIN").alias("verdict"),
        retrain.alias("should_retrain"),
        F.when(F.col("comparable").isNull(), "no_metrics")
        .when(retrain, "drift_over_threshold")
        .when(F.col("comparable") == 0, "nothing_comparable")
        .otherwise("within_limits")
        .alias("reason"),
        F.coalesce(F.array_join("drifted", ", "), F.lit("")).alias("triggered_by"),
        F.coalesce(F.array_join("gaps", ", "), F.lit("")).alias("not_comparable"),
    )
