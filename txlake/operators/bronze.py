"""Message envelope to bronze rows, wire encoding and run statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txlake.constants import WIRE_FIELDS
from txlake.functions.clock import parse_instant, utc_day
from txlake.schemas import payload_schema


def build_bronze_frame(
    raw: DataFrame, schema: T.StructType | None = None, now: Column | None = None
) -> DataFrame:
    """Shape source messages into bronze rows; nothing is dropped or deduplicated.

    A payload that is not JSON keeps its text in ``value`` and gets a ``data``
    struct of nulls.
    """
    stamp = F.current_timestamp() if now is None else now
    text = F.col("value").cast("string")
    return raw.select(
        F.col("key").cast("string").alias("key"),
        text.alias("value"),
        F.col("topic").alias("source_topic"),
        F.col("partition").cast("int").alias("_partition"),
        F.col("offset").cast("long").alias("_offset"),
        F.col("timestamp").alias("_kafka_timestamp"),
        F.from_json(text, schema or payload_schema()).alias("data"),
        stamp.alias("ingestion_time"),
        utc_day(stamp).alias("ingestion_date"),
    )


def encode_wire(transactions: DataFrame) -> DataFrame:
    """Transactions to message rows: key ``account_id``, value compact JSON in field order."""
    record = F.struct(*[F.col(f) for f in WIRE_FIELDS])
    return transactions.select(
        F.col("account_id").alias("key"),
        F.to_json(record, {"ignoreNullFields": "false"}).alias("value"),
    )


def ingest_run_stats(bronze: DataFrame) -> DataFrame:
    """Messages, frauds and late arrivals of a run, in total and by currency.

    A row is late when its event time lies before the second it was received
    in. Rows come as scope ``run`` (one) and ``currency`` (one each).
    """
    received = F.col("_kafka_timestamp")
    late = F.unix_micros(parse_instant(F.col("data.timestamp"))) < F.unix_seconds(received) * 1000000
    by_currency = (
        bronze.filter(F.col("data.transaction_id").isNotNull())
        .groupBy(F.col("data.currency").alias("currency"))
        .agg(
            F.count(F.lit(1)).alias("produced"),
            F.count_if(F.col("data.is_fraud_label")).alias("fraud"),
            F.count_if(late).alias("late"),
            F.min(F.unix_micros(received)).alias("_first"),
            F.max(F.unix_micros(received)).alias("_last"),
        )
    )
    # A wire currency is free text, so the total is taken over the grouped rows, in one exchange.
    lines = F.explode(
        F.array(
            F.struct(F.lit("run").alias("scope"), F.lit(None).cast("string").alias("currency")),
            F.struct(F.lit("currency").alias("scope"), F.col("currency").alias("currency")),
        )
    )
    elapsed = F.greatest((F.max("_last") - F.min("_first")) / 1000000, F.lit(1e-9))
    counted = [F.sum(c).alias(c) for c in ("produced", "fraud", "late")]
    return (
        by_currency.select(lines.alias("line"), "produced", "fraud", "late", "_first", "_last")
        .groupBy("line.scope", "line.currency")
        .agg(
            *counted,
            F.round(elapsed, 2).alias("elapsed_seconds"),
            F.round(F.sum("produced") / elapsed, 2).alias("effective_rate"),
        )
    )
