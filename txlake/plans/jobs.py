"""The jobs a user submits: silver, gold, and the gated pipeline."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txlake.constants import FRAUD_THRESHOLD, HORIZON_DAYS, MAX_QUARANTINE_RATIO, SILVER_COLUMNS
from txlake.operators import drift, gold, quality, silver
from txlake.operators.scoring import Scorer, add_fraud_scores, load_or_default
from txlake.operators.training import train
from txlake.sources import reports, shared, tables
from txlake.sources.fx import fx_rates

STEPS = ("aggregates", "scoring", "drift", "all")


class GateFailed(RuntimeError):
    """The quality gate found failures, or no report to judge."""


@dataclass(frozen=True)
class Layout:
    """Where one lakehouse keeps its tables, and the unit its event tables are cut by."""

    root: str
    unit: str = "day"

    @property
    def bronze(self) -> str:
        return f"{self.root}/bronze/transactions"

    @property
    def silver(self) -> str:
        return f"{self.root}/silver/transactions"

    @property
    def quarantine(self) -> str:
        return f"{self.root}/silver/quarantine"

    @property
    def gold(self) -> str:
        return f"{self.root}/gold"

    @property
    def reports(self) -> str:
        return f"{self.root}/reports"

    @property
    def model(self) -> str:
        return f"{self.root}/model"


def run_silver(
    spark: SparkSession,
    layout: Layout,
    run_id: str,
    as_of: date,
    horizon_days: int = HORIZON_DAYS,
    bronze: DataFrame | None = None,
    upsert: Callable[[DataFrame], None] | None = None,
    profile_of: Callable[[int], DataFrame] | None = None,
    within: Sequence[str] = (),
) -> DataFrame:
    """Bronze to silver, quarantine and quality report; returns the metrics row.

    The bronze scan, JSON and rules run once: tagged rows are staged, and
    everything after filters its own half of them. Folders of ``is_valid`` would
    cost a sort of all rows. The upsert writes days already clustered by account. ``upsert`` and ``profile_of``
    (from the number of rejects) may take the place of the whole-table forms.

    ``within`` names columns that an id determines, and that ``bronze`` is stored in buckets of: then the latest
    rows are found where they lie, and only these and the rejects are staged, for all that follows.
    """
    if bronze is None:
        bronze = tables.read_bronze(spark, layout.bronze, as_of, horizon_days)
    tagged = silver.tagged_silver(bronze, fx_rates(spark), within)
    if within:
        tagged = silver.latest_and_rejected(tagged, within)
    staging = shared.fresh_path(spark, "tagged")
    tagged.write.parquet(staging, compression=shared.CODEC)
    tagged = spark.read.schema(tagged.schema).parquet(staging)

    if within:
        latest = tagged.filter("is_valid").select(*SILVER_COLUMNS)
    else:
        latest = silver.deduplicate(silver.valid_rows(tagged))
    if upsert is None:
        tables.upsert_silver(spark, latest, layout.silver, unit=layout.unit, stored=bool(within))
    else:
        upsert(latest)
    rejected = silver.quarantined_rows(tagged)
    quarantined = rejected.count()
    if quarantined:
        tables.append_quarantine(rejected, layout.quarantine)
    shared.delete(spark, staging)

    if profile_of is None:
        profile = quality.quality_profile(tables.read_silver(spark, layout.silver), quarantined, run_id)
    else:
        profile = profile_of(quarantined)
    reports.write_report(profile, layout.reports, "quality_metrics", run_id)
    metrics = reports.read_report(spark, layout.reports, "quality_metrics", run_id)
    reports.write_report(
        quality.quality_checks(metrics), layout.reports, "quality_checks", run_id
    )
    return metrics


def require_gate(
    spark: SparkSession,
    layout: Layout,
    run_id: str,
    max_quarantine_ratio: float = MAX_QUARANTINE_RATIO,
) -> None:
    """Raise unless the run's quality report exists and passes."""
    metrics = reports.read_report(spark, layout.reports, "quality_metrics", run_id)
    if metrics.isEmpty():
        raise GateFailed(f"no quality report for run {run_id}")
    checks = reports.read_report(spark, layout.reports, "quality_checks", run_id)
    # at most one line per check plus the ratio
    found = quality.quality_gate(metrics, checks, max_quarantine_ratio).orderBy("failure").collect()
    if found:
        raise GateFailed("; ".join(row["failure"] for row in found))


def write_aggregates(silver_rows: DataFrame, layout: Layout) -> None:
    for name, rows, unit in (
        ("daily_volume_by_country", gold.daily_volume_by_country(silver_rows), layout.unit),
        ("merchant_category_kpi", gold.merchant_category_kpi(silver_rows), None),
        ("account_velocity", gold.account_velocity(silver_rows), layout.unit),
        ("fraud_signals", gold.fraud_signals(silver_rows), layout.unit),
    ):
        tables.write_gold(rows, f"{layout.gold}/{name}", unit)


def write_scores(
    silver_rows: DataFrame, layout: Layout, scorer: Scorer, threshold: float | None
) -> None:
    scored = add_fraud_scores(silver_rows, scorer, threshold)
    tables.write_gold(scored, f"{layout.gold}/scored_transactions", layout.unit)


def write_drift(
    spark: SparkSession, layout: Layout, scorer: Scorer, run_id: str, sample_size: int | None = None
) -> DataFrame:
    """Drift of the stored scores against the model's reference, over all rows by default."""
    live = spark.read.parquet(f"{layout.gold}/scored_transactions")
    if sample_size is not None:
        live = drift.live_sample(live, sample_size)
    reference = scorer.reference
    if reference is None:
        reference = spark.createDataFrame([], "feature STRING, value DOUBLE")
    report = drift.drift_report(reference, live, run_id=run_id)
    reports.write_report(report, layout.reports, "drift_metrics", run_id)
    return reports.read_report(spark, layout.reports, "drift_metrics", run_id)


def run_gold(
    spark: SparkSession,
    layout: Layout,
    run_id: str,
    step: str = "all",
    threshold: float | None = FRAUD_THRESHOLD,
    sample_size: int | None = None,
) -> None:
    """One gold step, or all; each reads from storage and can be restarted alone."""
    if step not in STEPS:
        raise ValueError(f"unknown step {step}; one of {', '.join(STEPS)}")
    scorer = load_or_default(spark, layout.model)
    if step in ("aggregates", "all"):
        write_aggregates(tables.read_silver(spark, layout.silver), layout)
    if step in ("scoring", "all"):
        write_scores(tables.read_silver(spark, layout.silver), layout, scorer, threshold)
    if step in ("drift", "all"):
        write_drift(spark, layout, scorer, run_id, sample_size)


def retraining_verdict(spark: SparkSession, layout: Layout, run_id: str, **policy) -> DataFrame:
    """Decision row for one run; NO_RETRAIN when its drift report is missing."""
    runs = spark.createDataFrame([(run_id,)], "run_id STRING")
    report = reports.read_report(spark, layout.reports, "drift_metrics", run_id)
    return drift.decide_retraining(runs, report, **policy)


def run_pipeline(
    spark: SparkSession,
    layout: Layout,
    run_id: str,
    as_of: date,
    horizon_days: int = HORIZON_DAYS,
    max_quarantine_ratio: float = MAX_QUARANTINE_RATIO,
    bronze: DataFrame | None = None,
    within: Sequence[str] = (),
) -> str:
    """Silver, gate, gold, drift, decision, and training only on RETRAIN.

    A failing gate raises before any gold table is touched. Returns the verdict.
    """
    run_silver(spark, layout, run_id, as_of, horizon_days, bronze, within=within)
    require_gate(spark, layout, run_id, max_quarantine_ratio)
    run_gold(spark, layout, run_id)
    verdict = retraining_verdict(spark, layout, run_id).select(F.col("verdict")).first()[0]
    if verdict == "RETRAIN":
        train(spark, tables.read_silver(spark, layout.silver), layout.model)
    return verdict
