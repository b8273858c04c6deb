"""Bronze to silver: typing, exchange rates, rule tags, split, latest-wins dedup."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txlake.constants import SILVER_COLUMNS
from txlake.functions.clock import parse_instant, utc_day
from txlake.functions.money import to_pln
from txlake.functions.rules import Rule, broken_rules, passes, standard_rules
from txlake.sources.shared import more_partitions

#: A message's place in its topic, kept with rejects: together they tell messages apart.
COORDINATES = ("source_topic", "_partition")
#: Hash buckets that ids are counted in, and how many times the average makes one hot.
ID_BUCKETS, HOT_TIMES = 4096, 4
ORDER_COLUMNS = ("ingestion_time", "_offset", "_partition", "_value_hash")


def cast_and_extract(bronze: DataFrame, kept: Sequence[str] = ()) -> DataFrame:
    """Flatten ``data`` into typed columns; ids are kept as sent, and so are the columns ``kept``.

    The message's coordinates and a hash of ``value`` ride along when bronze has them:
    rejects are told apart by them, and they are last tie-breakers of the dedup order.
    """
    data = F.col("data")

    def folded(field: str, fold) -> Column:
        return fold(F.trim(data[field])).alias(field)

    ties = [F.col(c) for c in COORDINATES if c in bronze.columns]
    if "value" in bronze.columns:
        ties.append(F.xxhash64("value").alias("_value_hash"))
    return bronze.select(
        data["transaction_id"].cast("string").alias("transaction_id"),
        parse_instant(data["timestamp"]).alias("event_time"),
        data["account_id"].cast("string").alias("account_id"),
        data["amount"].try_cast("double").alias("amount"),
        folded("currency", F.upper),
        folded("merchant_category", F.lower),
        folded("country", F.upper),
        folded("channel", F.upper),
        data["device_id"].cast("string").alias("device_id"),
        data["is_fraud_label"].try_cast("boolean").alias("is_fraud_label"),
        "ingestion_time",
        "_offset",
        *ties,
        *kept,
    )


def normalize(typed: DataFrame, rates: DataFrame) -> DataFrame:
    """Add the UTC ``event_date``, the exchange rate and ``amount_pln``.

    Left join: a row with an unknown currency stays, without a rate, and the
    currency rule rejects it later.
    """
    return (
        typed.withColumn("event_date", utc_day(F.col("event_time")))
        .join(rates, "currency", "left")
        .withColumn("amount_pln", to_pln(F.col("amount"), F.col("fx_rate_to_pln")))
        .withColumn("fx_rate_to_pln", F.col("fx_rate_to_pln").cast("double"))
    )


def tag_errors(df: DataFrame, rules: Sequence[Rule] | None = None) -> DataFrame:
    """Add ``is_valid`` and ``dq_errors``, the names of the rules each row breaks."""
    rules = standard_rules() if rules is None else rules
    return df.withColumns({"is_valid": passes(rules), "dq_errors": broken_rules(rules)})


def tagged_silver(bronze: DataFrame, rates: DataFrame, kept: Sequence[str] = ()) -> DataFrame:
    """Every bronze row, typed, priced and tagged; no row is dropped."""
    return tag_errors(normalize(cast_and_extract(bronze, kept), rates))


def valid_rows(tagged: DataFrame, kept: Sequence[str] = ()) -> DataFrame:
    """Rows without errors, with the silver columns, the dedup tie-breakers and the columns ``kept``."""
    extra = [c for c in ORDER_COLUMNS[2:] if c in tagged.columns]
    return tagged.filter("is_valid").select(*SILVER_COLUMNS, *extra, *kept)


def quarantined_rows(tagged: DataFrame, now: Column | None = None) -> DataFrame:
    """Rows with errors, all columns, stamped with ``quarantine_time``."""
    stamp = F.current_timestamp() if now is None else now
    kept = [c for c in (*SILVER_COLUMNS, *COORDINATES, "dq_errors") if c in tagged.columns]
    return (
        tagged.filter("NOT is_valid").select(*kept).withColumn("quarantine_time", stamp)
    )


def split_valid_quarantine(
    df: DataFrame, rules: Sequence[Rule] | None = None, now: Column | None = None
) -> tuple[DataFrame, DataFrame]:
    """Split priced rows into (valid, quarantine)."""
    tagged = tag_errors(df, rules)
    return valid_rows(tagged), quarantined_rows(tagged, now)


def deduplicate(df: DataFrame, hot_ids: bool = True, within: Sequence[str] = (), wins: Column | None = None) -> DataFrame:
    """Latest row per ``transaction_id``.

    Order: ``ingestion_time``, ``_offset``, then the tie-breakers present, all
    descending with nulls last. ``row_number() = 1`` lets Spark keep one row per
    id *before* the shuffle (WindowGroupLimit), so a hot id does not travel.

    A table too large for the session's partitions is dealt over more of them before it
    is sorted, but for ids in the few hash buckets that hold far more rows than others.
    ``hot_ids=False`` says that there are none, which spares a scan.

    ``within`` names columns that an id determines: rows that are dealt by them already, such as
    buckets of a stored table, are ranked where they are. With these, ``wins`` may mark rows that go before
    all others of their id whatever their age, as the source of an upsert does.
    """
    if within:
        return _latest(df, within, wins)
    if wins is not None:
        raise ValueError("rows that win need columns to be ranked within")
    n = more_partitions(df)
    if n is None:
        return _latest(df)
    bucket = F.pmod(F.xxhash64("transaction_id"), F.lit(ID_BUCKETS))
    hot: list[int] = []
    if hot_ids:
        held = dict(df.groupBy(bucket.alias("bucket")).count().collect())  # ID_BUCKETS lines at most
        hot = [b for b, rows in held.items() if rows * ID_BUCKETS > HOT_TIMES * sum(held.values())]
    if not hot:
        return _latest(df.repartition(n, "transaction_id"))
    even = df.where(~bucket.isin(hot)).repartition(n, "transaction_id")
    return _latest(even).unionByName(_latest(df.where(bucket.isin(hot))))


def latest_and_rejected(tagged: DataFrame, within: Sequence[str]) -> DataFrame:
    """The latest valid row per id and all rejects of tagged rows that are dealt by ``within``, ranked where they are."""
    order = [F.col(c).desc_nulls_last() for c in ORDER_COLUMNS if c in tagged.columns]
    same = Window.partitionBy(*within, "transaction_id", "is_valid")
    ranked = tagged.withColumn("_rank", F.row_number().over(same.orderBy(*order)))
    kept = [c for c in (*SILVER_COLUMNS, *COORDINATES, "is_valid", "dq_errors") if c in tagged.columns]
    return ranked.filter("_rank = 1 OR NOT is_valid").select(*kept)


def _latest(df: DataFrame, within: Sequence[str] = (), wins: Column | None = None) -> DataFrame:
    order = [F.col(c).desc_nulls_last() for c in ORDER_COLUMNS if c in df.columns]
    if wins is not None:
        order.insert(0, wins.desc_nulls_last())
    ranked = df.withColumn(
        "_rank", F.row_number().over(Window.partitionBy(*within, "transaction_id").orderBy(*order))
    )
    return ranked.filter(F.col("_rank") == 1).select(*SILVER_COLUMNS)


def to_silver(bronze: DataFrame, rates: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Bronze to (silver, quarantine). Only valid rows are deduplicated.

    The two frames share one lineage; a job that needs both should stage
    :func:`tagged_silver` once (see ``plans.jobs.run_silver``).
    """
    tagged = tagged_silver(bronze, rates)
    return deduplicate(valid_rows(tagged)), quarantined_rows(tagged)
