"""Fraud signals, model features, the heuristic score and the PSI band."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from txlake.constants import (
    HEURISTIC_INTERCEPT,
    HEURISTIC_WEIGHTS,
    HIGH_AMOUNT_PLN,
    HIGH_RISK_CATEGORIES,
    HOME_COUNTRY,
    NIGHT_ENDS_HOUR,
    NIGHT_STARTS_HOUR,
    PSI_MODERATE_BELOW,
    PSI_STABLE_BELOW,
)
from txlake.functions.clock import utc_hour


def is_night(hour: Column) -> Column:
    return (hour < NIGHT_ENDS_HOUR) | (hour >= NIGHT_STARTS_HOUR)


def signal_columns(high_amount_pln: float = HIGH_AMOUNT_PLN) -> dict[str, Column]:
    """The five rule-based signals, by output name."""
    return {
        "signal_night": is_night(utc_hour(F.col("event_time"))),
        "signal_high_amount": F.col("amount_pln") >= high_amount_pln,
        "signal_foreign": F.col("country") != HOME_COUNTRY,
        "signal_high_risk_category": F.col("merchant_category").isin(*HIGH_RISK_CATEGORIES),
        "signal_card_not_present": F.col("channel") == "ONLINE",
    }


def _flag(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False)).cast("double")


def feature_columns() -> dict[str, Column]:
    """The seven model inputs; missing values read as 0 or as an empty text."""
    amount = F.coalesce(F.col("amount_pln"), F.lit(0.0))
    hour = F.coalesce(utc_hour(F.col("event_time")), F.lit(0))
    return {
        "log_amount_pln": F.log1p(F.greatest(amount, F.lit(0.0))),
        "hour": hour.cast("double"),
        "is_night": _flag(is_night(hour)),
        "is_online": _flag(F.col("channel") == "ONLINE"),
        "is_atm": _flag(F.col("channel") == "ATM"),
        "is_high_risk_category": _flag(F.col("merchant_category").isin(*HIGH_RISK_CATEGORIES)),
        # an unknown country counts as foreign
        "is_foreign": _flag(~F.col("country").eqNullSafe(HOME_COUNTRY)),
    }


def heuristic_score(features: dict[str, Column] | None = None) -> Column:
    """Logistic score of the weighted features; stays inside generated code."""
    inputs = features or feature_columns()
    z = F.lit(HEURISTIC_INTERCEPT)
    for name, weight in HEURISTIC_WEIGHTS.items():
        z = z + F.lit(weight) * inputs[name]
    return 1.0 / (1.0 + F.exp(-z))


def psi_band(psi: Column) -> Column:
    """Stability band of a population stability index."""
    return (
        F.when(psi < PSI_STABLE_BELOW, "stable")
        .when(psi < PSI_MODERATE_BELOW, "moderate")
        .otherwise("significant")
    )
