"""States of one partition each, whose merger equals the aggregate over the whole table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txlake.functions import money
from txlake.operators.ordered import unpivoted
from txlake.sources.shared import more_partitions, spread

#: Columns that the quality profile counts nulls of.
NULL_COUNTED = ("transaction_id", "account_id", "amount", "amount_pln")


def category_state(silver: DataFrame, partition: str) -> DataFrame:
    """A row per partition, category and account: distinct accounts can't be added up, but united."""
    return silver.groupBy(partition, "merchant_category", "account_id").agg(
        F.count(F.lit(1)).alias("tx_count"),
        F.sum(F.col("is_fraud_label").cast("int")).alias("fraud_count"),
        *money.sums(F.col("amount_pln"), "pln"),
    )


def category_kpi(states: DataFrame) -> DataFrame:
    """``gold.merchant_category_kpi`` from the states of all partitions."""
    return states.groupBy("merchant_category").agg(
        F.sum("tx_count").alias("tx_count"),
        F.count_distinct(F.col("account_id")).alias("distinct_accounts"),
        money.merged_total("pln").alias("total_volume_pln"),
        money.merged_mean("pln").alias("avg_amount_pln"),
        F.sum("fraud_count").alias("fraud_count"),
        money.rate(F.sum("fraud_count"), F.sum("tx_count")).alias("fraud_rate"),
    )


def quality_state(silver: DataFrame, partition: str) -> DataFrame:
    """A row per partition with what the quality profile counts, and how many amounts its mean leaves out."""
    nulls = [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in NULL_COUNTED]
    # counted apart: beside other aggregates each id would travel with a state of all of them
    ids = silver.where(F.col("transaction_id").isNotNull()).select(F.col(partition).alias("_of"), "transaction_id")
    each = spread(ids, more_partitions(silver), "_of", "transaction_id").distinct()
    counted = each.groupBy("_of").agg(F.count(F.lit(1)).alias("distinct_ids"))
    states = silver.groupBy(partition).agg(
        F.count(F.lit(1)).alias("row_count"),
        *nulls,
        F.min("amount").alias("amount_min"),
        F.max("amount").alias("amount_max"),
        F.count_if(F.col("is_fraud_label")).alias("fraud_count"),
        *money.sums(F.col("amount_pln"), "pln"),
    )
    joined = states.join(counted, F.col(partition).eqNullSafe(F.col("_of")), "left").drop("_of")
    return joined.withColumn("distinct_ids", F.coalesce("distinct_ids", F.lit(0)))


def merged_profile(states: DataFrame, repeats: int, quarantined: int, run_id: str) -> DataFrame:
    """``quality.quality_profile`` from the states of all partitions.

    ``repeats`` is by how much their numbers of distinct ids exceed the table's (``keys.repeats``).
    """

    def added(column: str):
        return F.coalesce(F.sum(column), F.lit(0))

    rows, frauds = added("row_count"), added("fraud_count")
    counted = states.agg(
        rows.alias("row_count"),
        (added("distinct_ids") - repeats).alias("distinct_transaction_ids"),
        *[added(f"null_{c}").alias(f"null_{c}") for c in NULL_COUNTED],
        F.min("amount_min").alias("amount_min"),
        F.max("amount_max").alias("amount_max"),
        money.merged_mean("pln").alias("avg_amount_pln"),
        frauds.alias("fraud_count"),
        F.coalesce(money.rate(frauds, rows), F.lit(0.0)).alias("fraud_rate"),
    )
    return counted.select(
        F.lit(run_id).alias("run_id"),
        "row_count",
        "distinct_transaction_ids",
        (F.col("row_count") - F.col("distinct_transaction_ids")).alias("duplicate_ids"),
        *[f"null_{c}" for c in NULL_COUNTED],
        "amount_min",
        "amount_max",
        "avg_amount_pln",
        "fraud_count",
        "fraud_rate",
        F.lit(quarantined).cast("long").alias("quarantined_count"),
    )


def value_state(rows: DataFrame, partition: str, features: Sequence[str]) -> DataFrame:
    """``partition, feature, value, n``: the histogram of each feature in each partition, one line per distinct value."""
    return unpivoted(rows, features, partition).groupBy(partition, "feature", "value").agg(F.count(F.lit(1)).alias("n"))


def merged_values(states: DataFrame) -> DataFrame:
    """``feature, value, n`` of some partitions together."""
    return states.groupBy("feature", "value").agg(F.sum("n").alias("n"))
