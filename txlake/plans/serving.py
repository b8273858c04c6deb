"""Serving queries over the gold views, as Spark SQL.

Top-k queries end their order with an id, so equal rows keep one order. Money is
summed as DECIMAL and rates divide as DOUBLE.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from txlake.constants import GOLD_TABLES

_VOLUME = "CAST(sum(CAST(total_volume_pln AS DECIMAL(28,2))) AS DOUBLE)"

_SIGNALS = """
    SELECT transaction_id, account_id, amount_pln, country, channel, merchant_category, signal_count
    FROM fraud_signals WHERE signal_count >= 3
    ORDER BY signal_count DESC, amount_pln DESC, transaction_id LIMIT {n}
"""

_FLAGGED = """
    SELECT transaction_id, account_id, amount_pln, country, merchant_category,
           round(fraud_score, 4) AS fraud_score, is_fraud_label
    FROM scored_transactions WHERE fraud_flag
    ORDER BY fraud_score DESC, transaction_id LIMIT {n}
"""

QUERIES = {
    "q1_top_countries": f"""
        SELECT country, sum(tx_count) AS tx_count, {_VOLUME} AS total_volume_pln,
               sum(fraud_count) AS fraud_count
        FROM daily_volume_by_country GROUP BY country
        ORDER BY total_volume_pln DESC, country LIMIT 10
    """,
    "q2_category_fraud_rate": """
        SELECT merchant_category, tx_count, fraud_count,
               round(fraud_count * 1.0e0 / tx_count, 5) AS fraud_rate, total_volume_pln
        FROM merchant_category_kpi WHERE tx_count >= 100
        ORDER BY fraud_rate DESC, merchant_category
    """,
    "q3_daily_fraud_trend": """
        SELECT event_date, sum(tx_count) AS tx_count, sum(fraud_count) AS fraud_count,
               round(sum(fraud_count) * 1.0e0 / nullif(sum(tx_count), 0), 5) AS fraud_rate
        FROM daily_volume_by_country GROUP BY event_date ORDER BY event_date
    """,
    "q4_high_velocity_accounts": """
        SELECT account_id, event_date, tx_count, distinct_countries, distinct_devices,
               total_amount_pln, max_amount_pln
        FROM account_velocity WHERE tx_count >= 5 AND distinct_countries >= 2
        ORDER BY tx_count DESC, distinct_countries DESC, account_id, event_date LIMIT 25
    """,
    "q5_strongest_signals": _SIGNALS.format(n=25),
    "q6_highest_scores": _FLAGGED.format(n=25),
    "q7_score_by_label": """
        SELECT is_fraud_label, count(*) AS n, round(avg(fraud_score), 4) AS avg_fraud_score
        FROM scored_transactions GROUP BY is_fraud_label ORDER BY is_fraud_label
    """,
    "kpi_row": f"""
        SELECT coalesce(sum(tx_count), 0) AS total_tx,
               coalesce({_VOLUME}, 0.0e0) AS total_volume_pln,
               coalesce(sum(fraud_count), 0) AS total_fraud,
               count(DISTINCT country) AS countries
        FROM daily_volume_by_country
    """,
    "volume_by_country": f"""
        SELECT country, sum(tx_count) AS tx_count, {_VOLUME} AS total_volume_pln,
               sum(fraud_count) AS fraud_count
        FROM daily_volume_by_country GROUP BY country ORDER BY total_volume_pln DESC, country
    """,
    "daily_trend": """
        SELECT event_date, sum(tx_count) AS tx_count, sum(fraud_count) AS fraud_count
        FROM daily_volume_by_country GROUP BY event_date ORDER BY event_date
    """,
    "category_kpi": """
        SELECT merchant_category, tx_count, fraud_count, fraud_rate, total_volume_pln
        FROM merchant_category_kpi ORDER BY fraud_rate DESC, merchant_category
    """,
    "top_scored": _FLAGGED.format(n=50),
    "top_signals": _SIGNALS.format(n=50),
    "fraud_headline": """
        SELECT coalesce(sum(tx_count), 0) AS total_tx, coalesce(sum(fraud_count), 0) AS total_fraud,
               coalesce(round(sum(fraud_count) * 1.0e0 / nullif(sum(tx_count), 0), 5), 0.0e0)
                   AS fraud_rate
        FROM daily_volume_by_country
    """,
}


def tables_of(name: str) -> list[str]:
    """The gold tables that a statement reads."""
    return [t for t in GOLD_TABLES if t in QUERIES[name]]


def serve(spark: SparkSession, name: str, gold_root: str) -> DataFrame:
    """Run one serving query over the gold tables under ``gold_root``, opening only those it reads."""
    frames = {t: spark.read.parquet(f"{gold_root}/{t}") for t in tables_of(name)}
    bound = QUERIES[name]
    for table in frames:
        bound = bound.replace(f"FROM {table}", f"FROM {{{table}}}")
    return spark.sql(bound, **frames)
