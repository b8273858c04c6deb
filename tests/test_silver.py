from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from tests.build import GOOD, bronze, silver_rows, tx
from txlake.constants import SILVER_COLUMNS
from txlake.operators import gold, silver
from txlake.sources.fx import fx_rates


def both(spark, *records):
    valid, rejected = silver.to_silver(bronze(spark, *records), fx_rates(spark))
    return valid.collect(), rejected.collect()


def test_values_are_folded_and_priced(spark):
    row = silver_rows(
        spark, tx(currency=" eur", country="de ", channel="pos", merchant_category=" Grocery ")
    ).first()
    assert (row.currency, row.country, row.channel) == ("EUR", "DE", "POS")
    assert row.merchant_category == "grocery"
    assert (row.fx_rate_to_pln, row.amount_pln) == (4.30, 430.0)


def test_silver_has_the_contract_columns(spark):
    assert silver_rows(spark, tx()).columns == list(SILVER_COLUMNS)


def test_split_names_the_broken_rules(spark):
    valid, rejected = both(
        spark, tx(), tx(transaction_id="t2", currency="xxx"), tx(transaction_id="t3", amount=-1.0)
    )
    assert [r.transaction_id for r in valid] == ["t1"]
    errors = {r.transaction_id: r.dq_errors for r in rejected}
    assert errors == {"t2": ["currency_allowed"], "t3": ["amount_in_range"]}
    assert all(r.quarantine_time is not None for r in rejected)


def test_unknown_currency_is_kept_without_a_rate(spark):
    _, rejected = both(spark, tx(currency="xxx"))
    assert (rejected[0].currency, rejected[0].fx_rate_to_pln) == ("XXX", None)


def test_every_missing_field_is_rejected(spark):
    fields = list(GOOD)
    rows = [tx(transaction_id=f"n{i}", **{f: None}) if f != "transaction_id" else tx(**{f: None})
            for i, f in enumerate(fields)]
    rows.append(dict.fromkeys(fields))
    valid, rejected = both(spark, tx(), *rows)
    assert len(valid) == 1
    assert len(rejected) == 11
    assert max(len(r.dq_errors) for r in rejected) == 10


def test_an_unknown_rule_result_fails_closed(spark):
    priced = silver.normalize(silver.cast_and_extract(bronze(spark, tx())), fx_rates(spark))
    rule = [("never_known", F.lit(None).cast("boolean"))]
    valid, rejected = silver.split_valid_quarantine(priced, rule)
    assert valid.count() == 0
    assert rejected.first().dq_errors == ["never_known"]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Tokyo"])
@pytest.mark.parametrize(
    "before, after",
    [
        ("2026-06-13T23:59:59+00:00", "2026-06-14T00:00:00+00:00"),
        ("2026-06-13T19:59:59-04:00", "2026-06-13T20:00:00-04:00"),
        ("2026-06-14T08:59:59+09:00", "2026-06-14T09:00:00+09:00"),
        ("2026-06-13T23:59:59", "2026-06-14T00:00:00"),
        ("2026-06-13", "2026-06-14"),
    ],
)
def test_event_date_is_the_utc_day(spark, zone, before, after):
    held = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        rows = silver_rows(
            spark, tx(timestamp=before), tx(transaction_id="t2", timestamp=after)
        ).orderBy("transaction_id")
        assert [r.event_date for r in rows.collect()] == [date(2026, 6, 13), date(2026, 6, 14)]
        hours = gold.fraud_signals(rows).orderBy("transaction_id").collect()
        if before.endswith("23:59:59+00:00"):
            assert [r.signal_night for r in hours] == [True, True]
    finally:
        spark.conf.set("spark.sql.session.timeZone", held)


@pytest.mark.parametrize("text", ["not-a-date", "", "2026-13-01T00:00:00+00:00", "20260613"])
def test_unreadable_times_are_rejected_not_raised(spark, text):
    valid, rejected = both(spark, tx(timestamp=text))
    assert not valid
    assert rejected[0].dq_errors == ["event_time_valid"]


def test_amount_bounds_apply_before_conversion(spark):
    valid, rejected = both(
        spark,
        tx(transaction_id="top", amount=1_000_000.0, currency="GBP"),
        tx(transaction_id="over", amount=1_000_000.01),
        tx(transaction_id="zero", amount=0.0),
        tx(transaction_id="nan", amount=float("nan")),
        tx(transaction_id="vast", amount=1e300),
    )
    assert [(r.transaction_id, r.amount_pln) for r in valid] == [("top", 5_050_000.0)]
    assert {r.transaction_id for r in rejected} == {"over", "zero", "nan", "vast"}


def test_money_rounds_half_up_in_decimal(spark):
    # 21.85 * 4.30 is 93.955 exactly; in binary it falls below and would round down
    row = silver_rows(spark, tx(amount=21.85, currency="EUR")).first()
    assert row.amount_pln == 93.96


def test_latest_copy_wins(spark):
    row = silver_rows(
        spark,
        tx(amount=10.0, received="2026-06-13T12:00:00+00:00", offset=9),
        tx(amount=20.0, received="2026-06-13T12:05:00+00:00", offset=1),
    ).collect()
    assert [r.amount for r in row] == [20.0]


def test_offset_breaks_a_time_tie(spark):
    rows = silver_rows(spark, tx(amount=1.0, offset=1), tx(amount=3.0, offset=3), tx(amount=2.0, offset=2))
    assert [r.amount for r in rows.collect()] == [3.0]


def test_a_newer_rejected_copy_does_not_displace_a_valid_one(spark):
    valid, rejected = both(
        spark,
        tx(amount=10.0, received="2026-06-13T12:00:00+00:00"),
        tx(amount=-5.0, received="2026-06-13T13:00:00+00:00"),
    )
    assert [r.amount for r in valid] == [10.0]
    assert [r.amount for r in rejected] == [-5.0]


def test_dedup_keeps_one_row_per_hot_id_before_the_shuffle(spark):
    rows = [tx(amount=float(i + 1), offset=i) for i in range(50)]
    rows += [tx(transaction_id=f"u{i}") for i in range(100)]
    kept = silver_rows(spark, *rows)
    assert kept.count() == 101
    assert kept.filter("transaction_id = 't1'").first().amount == 50.0
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2, "one limit before the exchange, one after"


def test_mixed_currency_totals(spark):
    rows = silver_rows(
        spark,
        tx(transaction_id="a", amount=100.0),
        tx(transaction_id="b", amount=100.0, currency="EUR"),
        tx(transaction_id="c", amount=20.0, account_id="A2"),
        tx(transaction_id="d", amount=10.0, currency="EUR", country="DE"),
        tx(transaction_id="e", amount=10.0, currency="GBP", country="DE"),
    )
    days = {r.country: (r.tx_count, r.total_volume_pln) for r in gold.daily_volume_by_country(rows).collect()}
    assert days == {"PL": (3, 550.0), "DE": (2, 93.5)}
    assert gold.merchant_category_kpi(rows).first().total_volume_pln == 643.5
    spent = {r.account_id: r.total_amount_pln for r in gold.account_velocity(rows).collect()}
    assert spent == {"A1": 623.5, "A2": 20.0}
