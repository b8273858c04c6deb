from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from tests.build import GOOD, tx
from txlake.constants import BRONZE_COLUMNS, WIRE_FIELDS
from txlake.functions.wire import with_wire_errors
from txlake.operators.bronze import build_bronze_frame, encode_wire, ingest_run_stats
from txlake.schemas import payload_schema


def envelope(spark, *values):
    lines = [("k", v, "transactions.raw", 0, i) for i, v in enumerate(values)]
    schema = "key STRING, value STRING, topic STRING, partition INT, offset BIGINT"
    return spark.createDataFrame(lines, schema).withColumn(
        "timestamp", F.timestamp_seconds(F.lit(1781352005))  # 2026-06-13T12:00:05Z
    )


def data_of(spark, value):
    return build_bronze_frame(envelope(spark, value)).select("data.*").first().asDict()


def errors_of(spark, *values):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i INT, value STRING")
    return [r.errors for r in with_wire_errors(frame).orderBy("i").collect()]


def test_bronze_columns_and_duplicates_are_kept(spark):
    frame = build_bronze_frame(envelope(spark, json.dumps(GOOD), json.dumps(GOOD)))
    assert frame.columns == list(BRONZE_COLUMNS)
    assert frame.count() == 2


def test_malformed_json_keeps_its_text(spark):
    row = build_bronze_frame(envelope(spark, "{not-json")).first()
    assert row.value == "{not-json"
    assert all(v is None for v in row.data.asDict().values())


@pytest.mark.parametrize(
    "change, field, expected",
    [
        ({"amount": "10"}, "amount", None),
        ({"amount": True}, "amount", None),
        ({"transaction_id": 5}, "transaction_id", "5"),
    ],
)
def test_payload_types(spark, change, field, expected):
    assert data_of(spark, json.dumps(tx(**change)))[field] == expected


def test_binary_messages_are_read_as_text(spark):
    raw = envelope(spark, json.dumps(GOOD)).withColumns(
        {"key": F.col("key").cast("binary"), "value": F.col("value").cast("binary")}
    )
    row = build_bronze_frame(raw).first()
    assert row.key == "k"
    assert row.data.transaction_id == "t1"


def test_wire_round_trip_keeps_field_order_and_nulls(spark):
    rows = spark.createDataFrame([tx(), tx(device_id=None)], payload_schema())
    sent = encode_wire(rows).collect()
    assert [r.key for r in sent] == ["A1", "A1"]
    assert list(json.loads(sent[0].value)) == list(WIRE_FIELDS)
    assert " " not in sent[0].value
    assert json.loads(sent[1].value)["device_id"] is None


def test_a_good_record_has_no_errors(spark):
    assert errors_of(spark, json.dumps(GOOD)) == [[]]


def test_one_missing_field_is_one_error(spark):
    short = {k: v for k, v in GOOD.items() if k != "transaction_id"}
    assert errors_of(spark, json.dumps(short)) == [["missing fields: transaction_id"]]


@pytest.mark.parametrize(
    "change, message",
    [
        ({"surprise": 1, "extra": 2}, "unexpected fields: extra, surprise"),
        ({"transaction_id": ""}, "transaction_id must be a non-empty string"),
        ({"account_id": 7}, "account_id must be a non-empty string"),
        ({"device_id": None}, "device_id must be a non-empty string"),
        ({"timestamp": "yesterday"}, "timestamp must be an ISO-8601 string"),
        ({"timestamp": 5}, "timestamp must be an ISO-8601 string"),
        ({"amount": "10"}, "amount must be a number"),
        ({"amount": True}, "amount must be a number"),
        ({"amount": 0}, "amount must be > 0, got 0"),
        ({"amount": -12.5}, "amount must be > 0, got -12.5"),
        ({"amount": -12345678.5}, "amount must be > 0, got -12345678.5"),
        (
            {"channel": "FAX"},
            "channel must be one of ('ONLINE', 'POS', 'ATM', 'MOBILE'), got 'FAX'",
        ),
        ({"channel": None}, "channel must be one of ('ONLINE', 'POS', 'ATM', 'MOBILE'), got None"),
        ({"channel": True}, "channel must be one of ('ONLINE', 'POS', 'ATM', 'MOBILE'), got True"),
        ({"is_fraud_label": 1}, "is_fraud_label must be a boolean"),
        ({"amount": -0.00001}, "amount must be > 0, got -1e-05"),
        ({"amount": -0.0001}, "amount must be > 0, got -0.0001"),
        ({"amount": -12345678.12345678}, "amount must be > 0, got -12345678.12345678"),
        ({"amount": -1e16}, "amount must be > 0, got -1e+16"),
        (
            {"currency": "pln"},
            "currency must be one of ('CNY', 'CZK', 'EUR', 'GBP', 'PLN', 'UAH', 'USD'), got 'pln'",
        ),
        (
            {"country": "ZZ"},
            "country must be one of ('PL', 'DE', 'FR', 'ES', 'IT', 'NL', 'SK', 'GB', 'US', 'CZ', 'UA', 'CN'), got 'ZZ'",
        ),
        (
            {"merchant_category": "Fuel"},
            "merchant_category must be one of ('grocery', 'restaurant', 'travel', 'electronics', 'fashion', 'fuel', "
            "'entertainment', 'health', 'utilities', 'cash_withdrawal', 'online_services', 'gambling'), got 'Fuel'",
        ),
    ],
)
def test_each_violation_has_its_message(spark, change, message):
    assert errors_of(spark, json.dumps(tx(**change))) == [[message]]


def test_errors_come_in_contract_order(spark):
    broken = tx(amount=-1, channel="FAX", transaction_id="", surprise=1)
    heads = [e.split(" ")[0] for e in errors_of(spark, json.dumps(broken))[0]]
    assert heads == ["unexpected", "transaction_id", "amount", "channel"]


def test_of_a_repeated_key_the_last_value_counts(spark):
    text = json.dumps(GOOD)[:-1]
    found = errors_of(spark, text + ', "channel": "FAX", "channel": "POS"}', text + ', "amount": -2.5}', '{"x": 1, "x": 2}')
    assert found[0] == [] and found[1] == ["amount must be > 0, got -2.5"]
    assert found[2][1] == "unexpected fields: x"


def test_non_objects(spark):
    found = errors_of(spark, "[1]", '"x"', "5", "5.5", "true", "null", "{oops", None)
    kinds = ["list", "str", "int", "float", "bool", "NoneType", "invalid JSON", "invalid JSON"]
    assert found == [[f"record must be a dict, got {k}"] for k in kinds]


@pytest.mark.parametrize(
    "text, good",
    [
        ("2026-06-13", True),
        ("20260613", True),
        ("2026-06-13T12:00", True),
        ("2026-06-13 12:00:00.5+02:00", True),
        ("2026-06-13T12:00:00Z", True),
        ("2026-W24-6", True),
        ("2025-W53-1", False),
        ("2026-W53-1", True),
        ("2026-02-29", False),
        ("2026-06-13T25:00", False),
        ("13/06/2026", False),
        ("0000-01-01", False),
        ("12:00:00", False),
    ],
)
def test_iso_forms(spark, text, good):
    assert errors_of(spark, json.dumps(tx(timestamp=text)))[0] == (
        [] if good else ["timestamp must be an ISO-8601 string"]
    )


def test_run_statistics(spark):
    late = tx(timestamp="2026-06-13T12:00:04+00:00", is_fraud_label=True)
    same_second = tx(timestamp="2026-06-13T12:00:05+00:00", currency="EUR")
    frame = build_bronze_frame(
        envelope(spark, json.dumps(late), json.dumps(same_second), "{not-json")
    )
    rows = {(r.scope, r.currency): r for r in ingest_run_stats(frame).collect()}
    run = rows[("run", None)]
    assert (run.produced, run.fraud, run.late) == (2, 1, 1)
    assert rows[("currency", "PLN")].produced == 1
    assert rows[("currency", "EUR")].late == 0
