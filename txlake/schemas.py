"""Spark schemas of the wire record, the message envelope and the report tables."""

from __future__ import annotations

from pyspark.sql import types as T

_WIRE_TYPES = {"amount": T.DoubleType(), "is_fraud_label": T.BooleanType()}


def payload_schema() -> T.StructType:
    """The ten wire fields, all nullable; ``timestamp`` stays text until silver."""
    from txlake.constants import WIRE_FIELDS

    return T.StructType([T.StructField(f, _WIRE_TYPES.get(f, T.StringType())) for f in WIRE_FIELDS])


def envelope_schema() -> T.StructType:
    """The six columns a message source delivers."""
    return T.StructType(
        [
            T.StructField("key", T.StringType()),
            T.StructField("value", T.StringType()),
            T.StructField("topic", T.StringType()),
            T.StructField("partition", T.IntegerType()),
            T.StructField("offset", T.LongType()),
            T.StructField("timestamp", T.TimestampType()),
        ]
    )


QUALITY_METRICS_DDL = (
    "run_id STRING, row_count BIGINT, distinct_transaction_ids BIGINT, duplicate_ids BIGINT, "
    "null_transaction_id BIGINT, null_account_id BIGINT, null_amount BIGINT, "
    "null_amount_pln BIGINT, amount_min DOUBLE, amount_max DOUBLE, avg_amount_pln DOUBLE, "
    "fraud_count BIGINT, fraud_rate DOUBLE, quarantined_count BIGINT"
)
QUALITY_CHECKS_DDL = "run_id STRING, check STRING, passed BOOLEAN"
DRIFT_METRICS_DDL = (
    "run_id STRING, feature STRING, psi DOUBLE, psi_band STRING, ks DOUBLE, "
    "reference_n BIGINT, live_n BIGINT"
)
