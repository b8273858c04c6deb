"""Row quality rules. A rule that evaluates to NULL counts as broken."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column
from pyspark.sql import functions as F

from txlake.constants import (
    AMOUNT_MAX_INCLUSIVE,
    AMOUNT_MIN_EXCLUSIVE,
    CHANNELS,
    COUNTRIES,
    CURRENCIES,
    MERCHANT_CATEGORIES,
)

Rule = tuple[str, Column]


def _present(name: str) -> Column:
    # Spark's trim removes spaces only, so a tab-only id passes; this is the gate's reading.
    return F.length(F.trim(F.col(name))) > 0


def standard_rules() -> list[Rule]:
    """The ten rules in report order, each as (name, condition that must hold)."""
    amount = F.col("amount")
    return [
        ("transaction_id_present", _present("transaction_id")),
        ("account_id_present", _present("account_id")),
        ("device_id_present", _present("device_id")),
        ("fraud_label_present", F.col("is_fraud_label").isNotNull()),
        ("event_time_valid", F.col("event_time").isNotNull()),
        ("amount_in_range", (amount > AMOUNT_MIN_EXCLUSIVE) & (amount <= AMOUNT_MAX_INCLUSIVE)),
        ("currency_allowed", F.col("currency").isin(*CURRENCIES)),
        ("country_allowed", F.col("country").isin(*COUNTRIES)),
        ("channel_allowed", F.col("channel").isin(*CHANNELS)),
        ("merchant_category_allowed", F.col("merchant_category").isin(*MERCHANT_CATEGORIES)),
    ]


def holds(condition: Column) -> Column:
    """The condition with SQL UNKNOWN closed to false."""
    return F.coalesce(condition, F.lit(False))


def passes(rules: Sequence[Rule]) -> Column:
    """True when every rule holds; a plain conjunction, so filters on it push down."""
    return reduce(and_, (holds(cond) for _, cond in rules))


def without_nulls(entries: Sequence[Column]) -> Column:
    """The non-null texts among distinct ones, in order; stays in generated code."""
    return F.array_except(F.array(*entries), F.array(F.lit(None).cast("string")))


def broken_rules(rules: Sequence[Rule]) -> Column:
    """Names of the rules a row breaks, in rule order (empty array when clean)."""
    return without_nulls([F.when(~holds(cond), F.lit(name)) for name, cond in rules])
