"""Small frames in the shapes the operators take."""

from __future__ import annotations

from pyspark.sql import functions as F

from txlake.functions.clock import parse_instant
from txlake.operators import silver
from txlake.schemas import payload_schema
from txlake.sources.fx import fx_rates

GOOD = {
    "transaction_id": "t1",
    "timestamp": "2026-06-13T12:00:00+00:00",
    "account_id": "A1",
    "amount": 100.0,
    "currency": "PLN",
    "merchant_category": "grocery",
    "country": "PL",
    "channel": "POS",
    "device_id": "D1",
    "is_fraud_label": False,
}


def tx(**changes):
    return {**GOOD, **changes}


def bronze(spark, *records, received="2026-06-13T12:00:05+00:00"):
    """Bronze-like rows; a record may carry its own ``received`` and ``offset``."""
    lines = []
    for i, record in enumerate(records):
        record = dict(record)
        stamp, offset = record.pop("received", received), record.pop("offset", i)
        lines.append((record, stamp, offset))
    schema = f"data {payload_schema().simpleString()}, received STRING, _offset BIGINT"
    frame = spark.createDataFrame(lines, schema)
    return frame.select("data", parse_instant(F.col("received")).alias("ingestion_time"), "_offset")


def silver_rows(spark, *records):
    return silver.to_silver(bronze(spark, *records), fx_rates(spark))[0]
