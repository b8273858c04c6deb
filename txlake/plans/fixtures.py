"""Transactions and messages derived by Spark from the star-schema test tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txlake.constants import MERCHANT_CATEGORIES
from txlake.functions.clock import instant_from_utc
from txlake.sources.shared import more_partitions, spread

TX_CATEGORIES = ("Grocery", *MERCHANT_CATEGORIES[1:])
TX_COUNTRIES = ("pl", "DE", "FR", "ES", "IT", "NL", "SK", "GB", "US", "CZ", "UA", "CN", "PL")
TX_CURRENCIES = ("PLN", "eur", "USD", " GBP ", "CZK", "UAH", "CNY")
TX_CHANNELS = ("online", "POS", "ATM", "MOBILE")
#: The order that a message speaks of; its id is made from it, so rows of one id have one of these.
ORDER_KEY = "order_key"
EV_CURRENCIES = ("PLN", "EUR", "USD", "GBP", "CZK", "UAH", "CNY")
EV_COUNTRIES = ("PL", "DE", "FR", "ES", "IT", "NL", "SK", "GB", "US", "CZ", "UA", "CN")
EV_CHANNELS = ("ONLINE", "POS", "ATM", "MOBILE")


def _pick(words: tuple[str, ...], index: Column) -> Column:
    return F.get(F.array(*[F.lit(w) for w in words]), index.cast("int"))


def _text(column: Column) -> Column:
    return column.cast("string")


def tx_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with what messages are made of, and ``ingestion_time, _offset``.

    Numbers alone, which are a fifth of a message: rows are joined and moved in this form.
    """
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice", "l_shipdate"
    )
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_custkey", "o_orderdate")
    customers = spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey", "c_nationkey")
    n, few = more_partitions(lines), more_partitions(orders)
    owned = spread(orders, few, "o_custkey").join(
        spread(customers, few, "c_custkey"), F.col("o_custkey") == F.col("c_custkey")
    )
    joined = spread(lines, n, "l_orderkey").join(spread(owned, n, "o_orderkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.select(
        "l_orderkey",
        "l_partkey",
        "l_suppkey",
        "l_linenumber",
        "l_extendedprice",
        "o_custkey",
        "o_orderdate",
        "c_nationkey",
        instant_from_utc(F.col("l_shipdate")).alias("ingestion_time"),
        (F.col("l_partkey") * 100000 + F.col("l_suppkey")).alias("_offset"),
    )


def tx_bronze(lines: DataFrame) -> DataFrame:
    """One bronze-like row per row of ``tx_lines``: ``data`` struct, ``ingestion_time``, ``_offset``, and columns added to it."""
    part, supp, line = F.col("l_partkey"), F.col("l_suppkey"), F.col("l_linenumber")
    order = F.col("l_orderkey")

    def every(n: int) -> Column:
        return part % n == 0

    stamp = F.concat(
        _text(F.col("o_orderdate").cast("date")),
        F.lit("T"),
        F.lpad(_text((part * 7 + line) % 24), 2, "0"),
        F.lit(":"),
        F.lpad(_text(supp % 60), 2, "0"),
        F.lit(":00"),
        F.when(line == 7, "-04:00").otherwise("+00:00"),
    )
    factor = F.when(every(97), -1).when(every(131), 100).otherwise(1)
    risky = (part % 12).isin(2, 3, 9, 10, 11)
    online = line % 4 == 0
    cut = F.when(risky & online, 8).when(risky | online, 3).otherwise(1)
    nation = F.col("c_nationkey") + F.when(part % 10 == 0, supp).otherwise(0)
    data = F.struct(
        F.when(every(127), "")
        .otherwise(F.concat(F.lit("T"), _text(order), F.lit("-"), _text(line)))
        .alias("transaction_id"),
        F.when(every(83), "not-a-date").otherwise(stamp).alias("timestamp"),
        F.when(every(101), "  ")
        .otherwise(F.concat(F.lit("ACC-"), _text(F.col("o_custkey"))))
        .alias("account_id"),
        (F.col("l_extendedprice").cast("decimal(18,2)") * factor).cast("double").alias("amount"),
        F.when(every(89), "xxx").otherwise(_pick(TX_CURRENCIES, supp % 7)).alias("currency"),
        F.when(every(109), "smuggling")
        .otherwise(_pick(TX_CATEGORIES, part % 12))
        .alias("merchant_category"),
        F.when(every(103), "ZZ").otherwise(_pick(TX_COUNTRIES, nation % 13)).alias("country"),
        F.when(every(107), "FAX").otherwise(_pick(TX_CHANNELS, line % 4)).alias("channel"),
        F.when(supp % 53 != 0, F.concat(F.lit("DEV-"), _text(supp))).alias("device_id"),
        F.when(~every(113), (order * 31 + line * 7 + part) % 100 < cut).alias("is_fraud_label"),
    )
    added = lines.columns[lines.columns.index("_offset") + 1 :]
    return lines.select(data.alias("data"), "ingestion_time", "_offset", *added)


def ev_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One message per event, with malformed payloads, extra fields, resends and late rows."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    e, user = F.col("event_id"), F.col("user_id")
    late = F.when(e % 40 == 0, e % 600 + 1).otherwise(0)
    sent = F.timestamp_add("SECOND", (-late).cast("long"), F.date_trunc("second", F.col("ts")))
    quoted = [
        ("transaction_id", F.concat(F.lit("E"), _text(F.when(e % 50 == 1, e - 1).otherwise(e)))),
        (
            "timestamp",
            F.concat(
                F.date_format(sent.cast("timestamp_ntz"), "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+00:00")
            ),
        ),
        ("account_id", F.concat(F.lit("ACC-"), _text(user))),
        ("amount", F.col("value").cast("decimal(18,2)")),
        ("currency", _pick(EV_CURRENCIES, e % 7)),
        ("merchant_category", _pick(MERCHANT_CATEGORIES, e % 12)),
        ("country", _pick(EV_COUNTRIES, e % 12)),
        ("channel", _pick(EV_CHANNELS, e % 4)),
        ("device_id", F.concat(F.lit("DEV-"), _text(user % 40))),
        ("is_fraud_label", e % 50 == 0),
    ]
    bare = ("amount", "is_fraud_label")
    pieces: list[Column] = []
    for i, (name, value) in enumerate(quoted):
        mark = "" if name in bare else '"'
        pieces += [F.lit(f'{"," if i else ""}"{name}":{mark}'), _text(value), F.lit(mark)]
    payload = F.concat(
        F.lit("{"), *pieces, F.when(e % 61 == 0, ',"surprise":1').otherwise(""), F.lit("}")
    )
    return events.select(
        F.concat(F.lit("ACC-"), _text(user)).alias("key"),
        F.when(e % 97 == 0, "{not-json").otherwise(payload).alias("value"),
        F.lit("transactions.raw").alias("topic"),
        (e % 3).cast("int").alias("partition"),
        F.floor(e / 3).cast("long").alias("offset"),
        instant_from_utc(F.col("ts")).alias("timestamp"),
    )
