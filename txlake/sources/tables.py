"""Lakehouse tables on plain Parquet: bounded scans, keyed upsert, overwrite, views.

Parquet has no transactions. Each write but the appends stages its rows first and
publishes by moving folders, and publishing again from the same staging is
harmless; a reader that lists the table in the middle of a publish may see it half
done. A table has one writer at a time: two would share its staging folder.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Collection, Sequence
from dataclasses import dataclass
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from txlake.constants import GOLD_TABLES, HORIZON_DAYS, SILVER_COLUMNS
from txlake.sources import shared

PARTITION = "event_date"
# Partition column by unit. A day is the default; a table with little data per day is better
# cut by month or year, whose column holds the first day of the unit.
UNITS = {"day": PARTITION, "month": "event_month", "year": "event_year"}


def placed(df: DataFrame, unit: str = "day") -> DataFrame:
    """Add the partition column of a unit coarser than a day."""
    return df if unit == "day" else df.withColumn(UNITS[unit], F.trunc(PARTITION, unit))


def horizon_filter(bronze: DataFrame, as_of: date, horizon_days: int = HORIZON_DAYS) -> DataFrame:
    """Rows ingested in the last ``horizon_days``; a negative horizon keeps all.

    On a table partitioned by ``ingestion_date`` the cutoff is a partition filter: older
    folders are listed but not read.
    """
    if horizon_days < 0:
        return bronze
    cutoff = F.date_sub(F.lit(as_of), horizon_days)
    return bronze.filter(F.col("ingestion_date") >= cutoff)


def read_bronze(
    spark: SparkSession, path: str, as_of: date, horizon_days: int = HORIZON_DAYS
) -> DataFrame:
    """The bronze table up to the horizon. Day folders before it are not even listed."""
    prefix = "ingestion_date="
    names = [n for n in shared.child_names(spark, path) if n.startswith(prefix)]
    if horizon_days < 0 or not names:
        return horizon_filter(spark.read.parquet(path), as_of, horizon_days)
    cutoff = f"{prefix}{as_of - timedelta(days=horizon_days)}"
    wanted = [n for n in names if n >= cutoff and n[len(prefix)].isdigit()]
    # one folder at least, so that an empty answer has the table's columns
    paths = [f"{path}/{n}" for n in wanted or names[-1:]]
    return horizon_filter(spark.read.option("basePath", path).parquet(*paths), as_of, horizon_days)


def _rebalanced(df: DataFrame, partition: str) -> DataFrame:
    # AQE splits a partition value that holds much of the data and merges small ones.
    return df.hint("rebalance", partition)


def write_partitioned(df: DataFrame, path: str, unit: str = "day") -> None:
    partition = UNITS[unit]
    _rebalanced(placed(df, unit), partition).write.mode("overwrite").partitionBy(partition).parquet(path, compression=shared.CODEC)


def merged_rows(target: DataFrame, source: DataFrame, key: str = "transaction_id") -> DataFrame:
    """Upsert as a query: all of ``source`` and the ``target`` rows it does not replace."""
    n = shared.more_partitions(target, source)
    kept = shared.spread(target, n, key).join(shared.spread(source.select(key), n, key), key, "left_anti")
    return source.unionByName(kept.select(*source.columns))


def _sums(df: DataFrame) -> list[Column]:
    """Two checksums of a row, of 96 bits together; a null differs from all values, and 0.0 from -0.0."""
    kinds = dict(df.dtypes)
    cells = [F.col(c).cast("string") if kinds[c] in ("double", "float") else F.col(c) for c in df.columns]
    nulls = F.concat(*[F.when(F.col(c).isNull(), "1").otherwise("0") for c in df.columns])
    return [F.xxhash64(nulls, *cells).alias("_sum"), F.hash(nulls, *cells).alias("_more")]


def changed_partitions(target: DataFrame, source: DataFrame, key: str, partition: str) -> tuple[set[date], bool]:
    """The partitions that an upsert of ``source`` changes, and whether rows of ``target`` in these have a key of its.

    A row that ``target`` holds already, and once, changes nothing. Keys and checksums are compared, by one shuffle of both sides.
    """
    columns = source.columns
    n = shared.more_partitions(target, source)
    old = target.select(*columns).where(F.col(key).isNotNull())
    old = old.select(F.col(key), F.col(partition).alias("_held"), *[c.alias(f"_old{i}") for i, c in enumerate(_sums(old))])
    new = source.where(F.col(key).isNotNull()).select(F.col(key), F.col(partition), *_sums(source))
    pairs = shared.spread(new, n, key).join(shared.spread(old, n, key), key, "left")
    equal = F.coalesce((F.col("_sum") == F.col("_old0")) & (F.col("_more") == F.col("_old1")), F.lit(False))
    by_key = pairs.groupBy(key).agg(
        F.count(F.lit(1)).alias("n"), F.bool_and(equal).alias("same"), F.max(partition).alias("placed"), F.max("_held").alias("held")
    )
    shown = by_key.select(
        F.explode(F.when(F.col("held").isNull(), F.array("placed")).otherwise(F.array("placed", "held"))).alias("day"),
        (F.col("n") > 1).alias("several"),
        ((F.col("n") > 1) | ~F.col("same")).alias("changed"),
        F.col("held").isNotNull().alias("known"),
    )
    lines = shown.distinct().collect()  # a few lines per partition
    days = {r.day for r in lines if r.changed}
    if any(r.several for r in lines):  # a key that either side has more than once, which no upsert leaves behind
        several = by_key.where("n > 1").select(key)
        found = [side.select(key, partition).join(several, key, "left_semi") for side in (target, source)]
        days |= {r[0] for r in found[0].union(found[1]).select(partition).distinct().collect()}
    days |= {r[0] for r in source.where(F.col(key).isNull()).select(partition).distinct().collect()}
    return days, any(r.known and (r.several or r.day in days) for r in lines)


def partition_values(spark: SparkSession, path: str, partition: str) -> list[date]:
    """The partitions of a table, from the names of its folders."""
    prefix = f"{partition}="
    names = [n for n in shared.child_names(spark, path) if n.startswith(prefix)]
    return [date.fromisoformat(n.removeprefix(prefix)) for n in names]


def read_silver(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).select(*SILVER_COLUMNS)


def read_partitions(
    spark: SparkSession, path: str, partition: str, days: Sequence[date], schema: StructType | None = None
) -> DataFrame:
    """The rows of some partitions; folders of others are not listed. Without a schema one of these tells it."""
    there = set(shared.child_names(spark, path))
    wanted = [f"{path}/{n}" for n in sorted({f"{partition}={d}" for d in days}) if n in there]
    reader = spark.read.option("basePath", path)
    if not wanted:
        return spark.createDataFrame([], schema or spark.read.parquet(path).schema)
    schema = schema or reader.parquet(wanted[0]).schema
    return reader.schema(schema).parquet(*wanted).select(*schema.fieldNames())


def upsert_silver(
    spark: SparkSession,
    valid: DataFrame,
    path: str,
    key: str = "transaction_id",
    unit: str = "day",
    stored: bool = False,
) -> None:
    """Insert or replace rows by key in a table partitioned by event day (or ``unit``).

    ``valid`` must hold each key once. Only the partitions it changes are
    rewritten: those of its rows that the table doesn't hold already, and those holding an older copy of
    one of their keys, which may have moved day. The batch is staged first, as it is read several times;
    ``stored`` says that it only filters a stored table. Every key of the table is read; ``keys.upsert_indexed`` needs its index instead,
    which this function drops, as it would miss the batch.
    """
    partition = UNITS[unit]
    valid = placed(valid, unit)
    publish_pending(spark, path)
    shared.delete(spark, index_root(path))
    batch = valid if stored else shared.stage(valid, "batch")
    try:
        if shared.holds_data(spark, path):
            target = spark.read.schema(batch.schema).parquet(path).select(*batch.columns)
            # Calendar days, not rows: a bounded list that becomes a partition filter.
            days, known = changed_partitions(target, batch, key, partition)
            merged = _changed_rows(target.filter(F.col(partition).isin(list(days))), batch, key, partition, days, known)
        else:
            merged, days = batch, {r[0] for r in batch.select(partition).distinct().collect()}
        if days:
            replace_partitions(spark, merged, path, partition, sorted(days))
    finally:
        if not stored:
            shared.discard(batch)


def _changed_rows(
    target: DataFrame, source: DataFrame, key: str, partition: str, days: Collection[date], known: bool
) -> DataFrame:
    """The rows of the partitions that an upsert changes; without a ``known`` key nothing is replaced, so nothing is joined."""
    source = source.filter(F.col(partition).isin(list(days)))
    return merged_rows(target, source, key) if known else source.unionByName(target.select(*source.columns))


def optimize_silver(
    spark: SparkSession, path: str, days: Sequence[date] | None = None, unit: str = "day"
) -> None:
    """Compact and re-cluster by account the given partitions, or all of the table."""
    partition = UNITS[unit]
    publish_pending(spark, path)
    if not shared.holds_data(spark, path):
        return
    silver = spark.read.parquet(path)
    if days is None:
        days = partition_values(spark, path, partition)
    else:
        silver = silver.filter(F.col(partition).isin(list(days)))
    replace_partitions(spark, silver, path, partition, days, changed=False)


def index_root(path: str) -> str:
    """Where the key index of a table lies."""
    return f"{path.rstrip('/')}.__keys"


def _touched_path(path: str) -> str:
    return f"{path.rstrip('/')}.__touched"


def track_changes(spark: SparkSession, path: str, reader: str) -> None:
    """From now on each publish notes for ``reader`` the partitions it changes, until they are forgotten."""
    shared.make_folder(spark, f"{_touched_path(path)}/{reader}")


def tracks_changes(spark: SparkSession, path: str, reader: str) -> bool:
    return shared.exists(spark, f"{_touched_path(path)}/{reader}")


def noted_changes(spark: SparkSession, path: str, reader: str) -> tuple[list[date], list[str]]:
    """Partitions changed since ``reader`` last forgot some, and the notes that say so."""
    root = f"{_touched_path(path)}/{reader}"
    notes = [f"{root}/{n}" for n in shared.child_names(spark, root)]
    if not notes:
        return [], []
    days = spark.read.text(notes).distinct().collect()  # one line per partition
    return sorted(date.fromisoformat(r[0].split("=")[1]) for r in days), notes


def forget_changes(spark: SparkSession, notes: Sequence[str]) -> None:
    for note in notes:
        shared.delete(spark, note)


def _pending_path(path: str) -> str:
    return f"{path.rstrip('/')}.__pending"


def replace_partitions(
    spark: SparkSession,
    rows: DataFrame,
    path: str,
    partition: str,
    days: Sequence[date],
    arrange: Callable[[DataFrame], DataFrame] | None = None,
    changed: bool = True,
) -> None:
    """Put ``rows`` in the place of some partitions; those without rows are dropped.

    ``arrange`` lays out the rows (``clustered`` by default); ``changed=False`` says that
    the partitions hold the same rows as before.
    """
    pending = _pending_path(path)
    # A staging folder without its plan was cut short, and is written again.
    shared.delete(spark, pending)
    (arrange or clustered)(rows).write.partitionBy(partition).parquet(f"{pending}/rows", compression=shared.CODEC)
    listed = {f"{partition}={d.isoformat()}" for d in days}
    filled = listed & set(shared.child_names(spark, f"{pending}/rows"))
    plan = {"filled": sorted(filled), "emptied": sorted(listed - filled), "changed": changed}
    spark.createDataFrame([(json.dumps(plan),)], "plan STRING").coalesce(1).write.text(
        f"{pending}/plan"
    )
    if not publish_pending(spark, path):
        raise OSError(f"the staged rewrite at {pending} has no plan")


def publish_pending(spark: SparkSession, path: str) -> bool:
    """Finish a staged rewrite: move the new days in, drop the emptied ones.

    Safe to repeat after a crash at any point: a filled day is replaced only
    while its new folder still waits in staging. False when nothing was staged to
    the end; a plan that can't be read is an error, as rows may wait behind it.
    """
    pending = _pending_path(path)
    if not shared.holds_data(spark, f"{pending}/plan"):
        return False
    try:
        plan = json.loads(spark.read.text(f"{pending}/plan").first()[0])
        filled, emptied = list(plan["filled"]), list(plan["emptied"])
    except (TypeError, KeyError, ValueError) as error:
        raise ValueError(f"unreadable plan in {pending}; nothing was published") from error
    for reader in shared.child_names(spark, _touched_path(path)) if plan.get("changed") else ():
        # before anything moves: a partition noted too often is only recomputed once more
        lines = spark.createDataFrame([(day,) for day in filled + emptied], "day STRING")
        lines.coalesce(1).write.text(f"{_touched_path(path)}/{reader}/{uuid.uuid4().hex}")
    waiting = set(shared.child_names(spark, f"{pending}/rows"))
    for day in filled:
        if day in waiting:
            shared.delete(spark, f"{path}/{day}")
            shared.rename(spark, f"{pending}/rows/{day}", f"{path}/{day}")
    for day in emptied:
        # Overwriting the filled days alone would leave a moved key behind in its old day.
        shared.delete(spark, f"{path}/{day}")
    shared.delete(spark, pending)
    spark.catalog.refreshByPath(path)
    return True


@dataclass(frozen=True)
class FolderTable:
    """A partitioned table as this module writes it, in the form that ``keys`` works on."""

    spark: SparkSession
    path: str
    partition: str

    def filled(self) -> bool:
        return shared.holds_data(self.spark, self.path)

    def settle(self) -> None:
        publish_pending(self.spark, self.path)

    def read(self, days: Sequence[date] | None = None, schema: StructType | None = None) -> DataFrame:
        if days is None:
            return self.spark.read.parquet(self.path)
        return read_partitions(self.spark, self.path, self.partition, days, schema)

    def replace(self, rows: DataFrame, days: Sequence[date]) -> None:
        replace_partitions(self.spark, rows, self.path, self.partition, days)


def append_quarantine(rejected: DataFrame, path: str, seen_keys: Sequence[str] = ()) -> bool:
    """Append rejects; nothing is written when there are none.

    By default a re-run appends again. With ``seen_keys``, rows already in the table are
    left out; nulls count as equal. The coordinates of a message are its topic,
    partition and offset together: offsets alone repeat over partitions.
    """
    spark = rejected.sparkSession
    if seen_keys and shared.holds_data(spark, path):
        known = read_quarantine(spark, path).select(*[F.col(k).alias(f"_seen_{k}") for k in seen_keys]).distinct()
        same = [F.col(k).eqNullSafe(F.col(f"_seen_{k}")) for k in seen_keys]
        rejected = rejected.join(known, reduce(lambda a, b: a & b, same), "left_anti")
    if rejected.isEmpty():
        return False
    rejected.write.mode("append").parquet(path, compression=shared.CODEC)
    return True


def read_quarantine(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("mergeSchema", "true").parquet(path)


def clustered(silver: DataFrame) -> DataFrame:
    """Rows ranged by day and account and sorted inside each range.

    ``transaction_id`` is the last range key, so an account with much of the
    data is cut into several ranges.
    """
    keys = (PARTITION, "account_id", "transaction_id")
    n = shared.more_partitions(silver)
    ranged = silver.repartitionByRange(n, *keys) if n else silver.repartitionByRange(*keys)
    return ranged.sortWithinPartitions(*keys)


def write_gold(df: DataFrame, path: str, unit: str | None = None) -> None:
    """Replace a gold table, its schema included; partitioned by event day or unit when given.

    The rows are written beside the table and moved in afterwards: a job that fails leaves
    the old table. A reader between the two moves finds none.
    """
    spark, staged = df.sparkSession, f"{path.rstrip('/')}.__staged"
    if unit:
        write_partitioned(df, staged, unit)
    else:
        df.write.mode("overwrite").parquet(staged, compression=shared.CODEC)
    shared.delete(spark, path)
    shared.rename(spark, staged, path)
    spark.catalog.refreshByPath(path)


def register_gold_views(
    spark: SparkSession, root: str, tables: Sequence[str] = GOLD_TABLES
) -> list[str]:
    """Temp view per gold table. A missing table is an error, an empty one is not.

    Call again to see a later write: a view keeps the files it was made over. The
    names are the tables', so a later call for another root takes them over.
    """
    for name in tables:
        path = f"{root}/{name}"
        spark.catalog.refreshByPath(path)
        spark.read.parquet(path).createOrReplaceTempView(name)
    return list(tables)
