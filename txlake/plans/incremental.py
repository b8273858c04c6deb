"""Jobs whose cost follows the change: silver by the key index, quality and gold by touched partitions.

Each publish of silver notes the partitions it changes before it moves them, for every
job that asked for it. A job recomputes the noted partitions and forgets the notes when
it is done, so a run that was cut short is made up for by the next one.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from txlake.constants import DRIFT_FEATURES, FRAUD_THRESHOLD, HORIZON_DAYS, SILVER_COLUMNS
from txlake.operators import drift, gold, states
from txlake.operators.scoring import Scorer, add_fraud_scores, load_or_default
from txlake.plans import jobs
from txlake.plans.jobs import Layout
from txlake.sources import keys, reports, shared, tables

KEY = "transaction_id"
GOLD, QUALITY = "gold", "quality"
#: With so few partitions a task's file for each of them is large enough; dealing rows by partition is a shuffle of them all.
FEW_PARTITIONS = 32
#: Tables with a row made of each one of silver's, so that their files are as silver's are.
BY_ROW = ("fraud_signals", "scored_transactions")

#: Rows of a table from the silver rows of the partitions it is recomputed for.
Build = Callable[[DataFrame], DataFrame]


def _state_path(layout: Layout, name: str) -> str:
    return f"{layout.root}/state/{name}"


def _refresh(spark: SparkSession, layout: Layout, path: str, build: Build, days: list[date]) -> None:
    """Recompute some partitions of a table, or all where there is no table yet."""
    partition = tables.UNITS[layout.unit]
    whole = not shared.holds_data(spark, path)
    if whole:
        days = tables.partition_values(spark, layout.silver, partition)
    if not days:
        return
    rows = build(tables.read_partitions(spark, layout.silver, partition, days))
    rows = rows if partition in rows.columns else tables.placed(rows, layout.unit)
    dealt = path.rsplit("/", 1)[1] in BY_ROW or len(days) <= FEW_PARTITIONS
    tables.replace_partitions(
        spark, rows, path, partition, days, arrange=lambda df: df if dealt else df.hint("rebalance", partition), changed=False
    )


def _due(spark: SparkSession, layout: Layout, reader: str) -> tuple[list[date], list[str]]:
    """Partitions to recompute, and the notes to forget afterwards; all partitions when none were noted so far."""
    tables.publish_pending(spark, layout.silver)
    if tables.tracks_changes(spark, layout.silver, reader):
        return tables.noted_changes(spark, layout.silver, reader)
    tables.track_changes(spark, layout.silver, reader)
    return tables.partition_values(spark, layout.silver, tables.UNITS[layout.unit]), []


def refresh_profile(spark: SparkSession, layout: Layout, run_id: str, quarantined: int) -> DataFrame:
    """The quality profile of silver, merged from one state a partition; only changed partitions are read."""
    partition = tables.UNITS[layout.unit]
    days, notes = _due(spark, layout, QUALITY)
    path = _state_path(layout, QUALITY)
    _refresh(spark, layout, path, lambda rows: states.quality_state(rows, partition), days)
    more = keys.repeats(tables.FolderTable(spark, layout.silver, partition), KEY)
    profile = shared.stage(states.merged_profile(spark.read.parquet(path), more, quarantined, run_id), "profile")
    tables.forget_changes(spark, notes)
    return profile


def run_silver(
    spark: SparkSession,
    layout: Layout,
    run_id: str,
    as_of: date,
    horizon_days: int = HORIZON_DAYS,
    bronze: DataFrame | None = None,
    within: Sequence[str] = (),
) -> DataFrame:
    """``jobs.run_silver`` with the indexed upsert and the merged profile; the same tables and report."""

    def upsert(latest: DataFrame) -> None:
        keys.upsert_indexed(spark, latest, layout.silver, KEY, layout.unit, stored=bool(within))

    def profile(quarantined: int) -> DataFrame:
        return refresh_profile(spark, layout, run_id, quarantined)

    return jobs.run_silver(spark, layout, run_id, as_of, horizon_days, bronze, upsert, profile, within)


def _scorer_stamp(spark: SparkSession, layout: Layout, scorer: Scorer, threshold: float | None) -> str:
    """What scores depend on besides the row."""
    return f"{scorer.kind} {scorer.threshold if threshold is None else threshold} {shared.stamp(spark, layout.model)}"


def run_gold(spark: SparkSession, layout: Layout, threshold: float | None = FRAUD_THRESHOLD) -> list[date]:
    """``jobs.run_gold``'s tables, recomputed for the partitions of silver that have changed; gives these.

    Aggregates, signals and scores are replaced by partition. The category table is
    merged from states of a partition, category and account each. Scores are made anew
    for all rows when the model or its threshold is another one than last time.
    """
    partition = tables.UNITS[layout.unit]
    days, notes = _due(spark, layout, GOLD)
    builds: dict[str, Build] = {
        "daily_volume_by_country": gold.daily_volume_by_country,
        "account_velocity": gold.account_velocity,
        "fraud_signals": gold.fraud_signals,
    }
    for name, build in builds.items():
        _refresh(spark, layout, f"{layout.gold}/{name}", lambda rows, build=build: build(rows.select(*SILVER_COLUMNS)), days)
    state, kpi = _state_path(layout, "categories"), f"{layout.gold}/merchant_category_kpi"
    _refresh(spark, layout, state, lambda rows: states.category_state(rows, partition), days)
    if days or not shared.holds_data(spark, kpi):
        tables.write_gold(states.category_kpi(spark.read.parquet(state)), kpi)

    scorer = load_or_default(spark, layout.model)
    used, stored = _scorer_stamp(spark, layout, scorer, threshold), _state_path(layout, "scorer")
    before = spark.read.text(stored).collect() if shared.holds_data(spark, stored) else []
    same = [r[0] for r in before] == [used]
    scored = days if same else tables.partition_values(spark, layout.silver, partition)
    path = f"{layout.gold}/scored_transactions"
    _refresh(spark, layout, path, lambda rows: add_fraud_scores(rows.select(*SILVER_COLUMNS), scorer, threshold), scored)
    values = _state_path(layout, "values")

    def histogram(rows: DataFrame) -> DataFrame:
        return states.value_state(add_fraud_scores(rows, scorer, threshold), partition, DRIFT_FEATURES)

    _refresh(spark, layout, values, histogram, scored)
    if not same:
        spark.createDataFrame([(used,)], "stamp STRING").coalesce(1).write.mode("overwrite").text(stored)
    tables.forget_changes(spark, notes)
    return days


def live_values(spark: SparkSession, layout: Layout, since: date | None = None, before: date | None = None) -> DataFrame:
    """``feature, value, n`` of the scored rows, from the histograms of partitions from ``since`` on and up to ``before``.

    A window that moves on reads other partitions' histograms, and no rows.
    """
    partition, path = tables.UNITS[layout.unit], _state_path(layout, "values")
    days = tables.partition_values(spark, path, partition)
    wanted = [d for d in days if (since is None or d >= since) and (before is None or d < before)]
    stored = tables.read_partitions(spark, path, partition, wanted)
    return states.merged_values(stored)


def write_drift(
    spark: SparkSession, layout: Layout, run_id: str, since: date | None = None, reference: DataFrame | None = None
) -> DataFrame:
    """``jobs.write_drift`` from the stored histograms; ``reference`` takes the place of the model's."""
    if reference is None:
        reference = load_or_default(spark, layout.model).reference
    if reference is None:
        reference = spark.createDataFrame([], "feature STRING, value DOUBLE")
    report = drift.drift_report(reference, live_values(spark, layout, since), run_id=run_id)
    reports.write_report(report, layout.reports, "drift_metrics", run_id)
    return reports.read_report(spark, layout.reports, "drift_metrics", run_id)
