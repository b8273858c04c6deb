"""Quality profile, checks, expectation suite and the gate that reads them."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txlake.constants import (
    AMOUNT_MAX_INCLUSIVE,
    AMOUNT_MIN_EXCLUSIVE,
    CHANNELS,
    COUNTRIES,
    CURRENCIES,
    MAX_QUARANTINE_RATIO,
    QUALITY_CHECKS,
    QUALITY_COUNTERS,
)
from txlake.functions import money
from txlake.functions.rules import without_nulls
from txlake.sources.shared import more_partitions, spread


def quality_profile(
    silver: DataFrame, quarantined: int | DataFrame = 0, run_id: str = "run"
) -> DataFrame:
    """One row of counters for a silver table.

    ``quarantined`` is a count or the quarantine frame itself.
    """
    if isinstance(quarantined, DataFrame):
        rejected = quarantined.agg(F.count(F.lit(1))).scalar()
    else:
        rejected = F.lit(quarantined).cast("long")

    def nulls(column: str) -> Column:
        return F.count_if(F.col(column).isNull()).alias(f"null_{column}")

    rows = F.count(F.lit(1))
    frauds = F.count_if(F.col("is_fraud_label"))
    counted = silver.agg(
        rows.alias("row_count"),
        nulls("transaction_id"),
        nulls("account_id"),
        nulls("amount"),
        nulls("amount_pln"),
        F.min("amount").alias("amount_min"),
        F.max("amount").alias("amount_max"),
        money.mean(F.col("amount_pln")).alias("avg_amount_pln"),
        frauds.alias("fraud_count"),
        F.coalesce(money.rate(frauds, rows), F.lit(0.0)).alias("fraud_rate"),
    )
    # counted apart: beside other aggregates each id would travel with a state of all of them
    ids = silver.where(F.col("transaction_id").isNotNull()).select("transaction_id")
    each = spread(ids, more_partitions(silver), "transaction_id").distinct()
    return counted.crossJoin(each.agg(F.count(F.lit(1)).alias("distinct_transaction_ids"))).select(
        F.lit(run_id).alias("run_id"),
        "row_count",
        "distinct_transaction_ids",
        (F.col("row_count") - F.col("distinct_transaction_ids")).alias("duplicate_ids"),
        "null_transaction_id",
        "null_account_id",
        "null_amount",
        "null_amount_pln",
        "amount_min",
        "amount_max",
        "avg_amount_pln",
        "fraud_count",
        "fraud_rate",
        rejected.alias("quarantined_count"),
    )


def _check_conditions() -> dict[str, Column]:
    low, high = F.col("amount_min"), F.col("amount_max")
    within = (low.isNull() | (low > AMOUNT_MIN_EXCLUSIVE)) & (
        high.isNull() | (high <= AMOUNT_MAX_INCLUSIVE)
    )
    conditions = [
        F.col("null_transaction_id") == 0,
        F.col("null_account_id") == 0,
        F.col("null_amount") == 0,
        F.col("null_amount_pln") == 0,
        F.col("duplicate_ids") == 0,
        within,
    ]
    return dict(zip(QUALITY_CHECKS, conditions, strict=True))


def quality_checks(metrics: DataFrame) -> DataFrame:
    """Six ``run_id, check, passed`` rows per metrics row."""
    entries = [
        F.struct(F.lit(name).alias("check"), F.coalesce(cond, F.lit(False)).alias("passed"))
        for name, cond in _check_conditions().items()
    ]
    return metrics.select("run_id", F.explode(F.array(*entries)).alias("c")).select(
        "run_id", "c.check", "c.passed"
    )


# --- expectation suite ----------------------------------------------------- #


def _suite() -> list[tuple[str, str, Column | None]]:
    """(expectation, column, condition of an unexpected row); None marks uniqueness."""
    entries: list[tuple[str, str, Column | None]] = []
    for name in ("transaction_id", "account_id", "event_time", "amount", "amount_pln", "currency"):
        entries.append(("expect_column_values_to_not_be_null", name, F.col(name).isNull()))
    entries.append(("expect_column_values_to_be_unique", "transaction_id", None))
    amount = F.col("amount")
    outside = (amount <= AMOUNT_MIN_EXCLUSIVE) | (amount > AMOUNT_MAX_INCLUSIVE)
    entries.append(("expect_column_values_to_be_between", "amount", outside))
    entries.append(("expect_column_values_to_be_between", "amount_pln", F.col("amount_pln") < 0))
    for name, words in (("currency", CURRENCIES), ("country", COUNTRIES), ("channel", CHANNELS)):
        entries.append(("expect_column_values_to_be_in_set", name, ~F.col(name).isin(*words)))
    return entries


def expectation_suite(silver: DataFrame) -> DataFrame:
    """One row per expectation with its unexpected row count.

    Rows are combined by id before the shuffle, so the whole suite costs one
    exchange of ids with counters.
    """
    suite = _suite()
    counters = [F.count(F.lit(1)).alias("_n")]
    for i, (_, _, unexpected) in enumerate(suite):
        if unexpected is not None:
            counters.append(F.count_if(unexpected).alias(f"_u{i}"))
    by_id = silver.groupBy("transaction_id").agg(*counters)
    repeated = F.sum(
        F.when(F.col("transaction_id").isNotNull() & (F.col("_n") > 1), F.col("_n")).otherwise(0)
    )
    sums = [
        F.coalesce(repeated if u is None else F.sum(f"_u{i}"), F.lit(0)).alias(f"_u{i}")
        for i, (_, _, u) in enumerate(suite)
    ]
    totals = by_id.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("row_count"), *sums)
    lines = [
        F.struct(
            F.lit(i + 1).alias("position"),
            F.lit(expectation).alias("expectation"),
            F.lit(column).alias("column_name"),
            F.col(f"_u{i}").alias("unexpected_count"),
        )
        for i, (expectation, column, _) in enumerate(suite)
    ]
    return totals.select("row_count", F.explode(F.array(*lines)).alias("e")).select(
        "e.position",
        "e.expectation",
        "e.column_name",
        "row_count",
        "e.unexpected_count",
        (F.col("e.unexpected_count") == 0).alias("success"),
    )


# --- gate ------------------------------------------------------------------- #

BAD_THRESHOLD = "invalid quarantine threshold"
BAD_METRICS = "missing or invalid quality metrics; regenerate the silver report"
BAD_CHECKS = "missing or invalid quality checks"
INCOMPLETE_CHECKS = "missing or duplicate quality checks; regenerate the silver report"


def _finite(value: Column) -> Column:
    return ~F.isnan(value) & (F.abs(value) != float("inf"))


def _sound_metrics() -> Column:
    sound = F.lit(True)
    for name in QUALITY_COUNTERS:
        sound = sound & F.coalesce(F.col(name) >= 0, F.lit(False))
    for name in ("amount_min", "amount_max"):
        bound = F.col(name)
        sound = sound & F.when(bound.isNull(), F.col("row_count") == 0).otherwise(_finite(bound))
    return F.coalesce(sound, F.lit(False))


def quality_gate(
    metrics: DataFrame, checks: DataFrame, max_quarantine_ratio: float = MAX_QUARANTINE_RATIO
) -> DataFrame:
    """Failures per run, ``run_id, failure``; a run without rows passed.

    The required checks are recomputed from the counters, so a stale summary
    cannot hide a measured failure. A damaged report gives one failure.
    """
    if not math.isfinite(max_quarantine_ratio) or not 0 <= max_quarantine_ratio <= 1:
        return metrics.select("run_id", F.lit(BAD_THRESHOLD).alias("failure")).distinct()

    by_check = checks.groupBy("run_id", "check").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("passed").isNull()).alias("untold"),
        F.bool_and("passed").alias("passed"),
    )
    by_run = by_check.groupBy("run_id").agg(
        F.max("n").alias("most"),
        F.max(F.col("check").isNull() | (F.col("untold") > 0)).alias("malformed"),
        F.count_if(F.col("check").isin(*QUALITY_CHECKS)).alias("required"),
        F.collect_set(F.when(~F.col("passed"), F.col("check"))).alias("stored"),  # names of checks, a few
    )
    judged = metrics.join(by_run, "run_id", "left")
    complete = F.coalesce((F.col("required") == len(QUALITY_CHECKS)) & (F.col("most") == 1), F.lit(False))
    damage = (
        F.when(~_sound_metrics(), BAD_METRICS)
        .when(F.coalesce("malformed", F.lit(False)), BAD_CHECKS)
        .when(~complete, INCOMPLETE_CHECKS)
    )
    recomputed = [
        F.when(~F.coalesce(cond, F.lit(False)), F.lit(name)) for name, cond in _check_conditions().items()
    ]
    names = F.array_union("stored", without_nulls(recomputed))
    failed = F.transform(names, lambda name: F.concat(F.lit("check failed: "), name))
    share = F.col("quarantined_count") / F.nullif(
        F.col("row_count") + F.col("quarantined_count"), F.lit(0)
    )
    too_many = F.when(
        share > max_quarantine_ratio,
        F.format_string(
            "quarantine ratio %.3f exceeds max %.3f", share, F.lit(float(max_quarantine_ratio))
        ),
    )
    found = F.when(damage.isNotNull(), F.array(damage)).otherwise(
        F.concat(failed, without_nulls([too_many]))
    )
    # one pass over the metrics: all of a run's failures are an array of one projection
    return judged.select("run_id", F.explode(found).alias("failure"))
