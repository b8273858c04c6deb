"""Gold aggregates and rule-based fraud signals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txlake.constants import COUNTRIES, HIGH_AMOUNT_PLN, MERCHANT_CATEGORIES
from txlake.functions import money
from txlake.functions.signals import signal_columns


def _frauds() -> Column:
    return F.sum(F.col("is_fraud_label").cast("int"))


def daily_volume_by_country(silver: DataFrame) -> DataFrame:
    """Count, PLN volume and fraud per UTC day and country."""
    return silver.groupBy("event_date", "country").agg(
        F.count(F.lit(1)).alias("tx_count"),
        money.total(F.col("amount_pln")).alias("total_volume_pln"),
        money.mean(F.col("amount_pln")).alias("avg_amount_pln"),
        _frauds().alias("fraud_count"),
        money.rate(_frauds(), F.count(F.lit(1))).alias("fraud_rate"),
    )


def merchant_category_kpi(silver: DataFrame, approximate: bool = False) -> DataFrame:
    """Count, distinct accounts, PLN volume and fraud per merchant category.

    The exact distinct count first combines on (category, account), so twelve
    large categories still spread over the cluster. ``approximate`` trades it
    for a sketch and one small shuffle.
    """
    distinct = F.approx_count_distinct if approximate else F.count_distinct
    return silver.groupBy("merchant_category").agg(
        F.count(F.lit(1)).alias("tx_count"),
        distinct(F.col("account_id")).alias("distinct_accounts"),
        money.total(F.col("amount_pln")).alias("total_volume_pln"),
        money.mean(F.col("amount_pln")).alias("avg_amount_pln"),
        _frauds().alias("fraud_count"),
        money.rate(_frauds(), F.count(F.lit(1))).alias("fraud_rate"),
    )


def _distinct_of(column: str, vocabulary: Sequence[str]) -> Column:
    """Distinct count of a closed-vocabulary column as the bits set in one long.

    A value outside the vocabulary stops the job: it must not be miscounted.
    """
    bit = F.lit(None).cast("long")
    for position, word in reversed(list(enumerate(vocabulary))):
        bit = F.when(F.col(column) == word, F.lit(1 << position).cast("long")).otherwise(bit)
    checked = F.when(
        F.col(column).isNotNull() & bit.isNull(),
        F.raise_error(F.concat(F.lit(f"{column} outside its vocabulary: "), F.col(column))).cast(
            "long"
        ),
    ).otherwise(bit)
    return F.coalesce(F.bit_count(F.bit_or(checked)), F.lit(0)).cast("long")


def account_velocity(silver: DataFrame, closed_vocabularies: bool = True) -> DataFrame:
    """Per account and UTC day: counts, amounts and distinct countries, devices, categories.

    Silver rows have passed the vocabulary rules, so countries and categories
    are counted as bits and only devices need a distinct aggregate; three
    distinct aggregates would copy every row four times (Expand). Pass
    ``closed_vocabularies=False`` for frames that skipped the rules.
    """
    if closed_vocabularies:
        countries = _distinct_of("country", COUNTRIES)
        categories = _distinct_of("merchant_category", MERCHANT_CATEGORIES)
    else:
        countries = F.count_distinct(F.col("country"))
        categories = F.count_distinct(F.col("merchant_category"))
    return silver.groupBy("account_id", "event_date").agg(
        F.count(F.lit(1)).alias("tx_count"),
        money.total(F.col("amount_pln")).alias("total_amount_pln"),
        F.max("amount_pln").alias("max_amount_pln"),
        countries.alias("distinct_countries"),
        F.count_distinct(F.col("device_id")).alias("distinct_devices"),
        categories.alias("distinct_categories"),
        _frauds().alias("fraud_count"),
    )


def fraud_signals(silver: DataFrame, high_amount_pln: float = HIGH_AMOUNT_PLN) -> DataFrame:
    """Five boolean signals per transaction and how many fired. No shuffle."""
    signals = signal_columns(high_amount_pln)
    return silver.select(
        "transaction_id",
        "event_time",
        "event_date",
        "account_id",
        "amount_pln",
        "country",
        "channel",
        "merchant_category",
        "is_fraud_label",
        *[cond.alias(name) for name, cond in signals.items()],
    ).withColumn("signal_count", sum((F.col(n).cast("int") for n in signals), F.lit(0)))
