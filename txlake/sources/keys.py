"""A key index beside a partitioned table, and the upsert that follows the batch with it.

The index is a Parquet table of (key, partition), cut by a hash of the key. It holds
every pair of the table and may hold more: pairs are written before the rows they
speak of are published, and a key that has moved leaves its old pair behind until
``compact``. So a crash between the two costs a partition that is looked into for
nothing, never a key that is missed. An index that is not there is built by one scan.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txlake.sources import shared, tables
from txlake.sources.tables import FolderTable
from txlake.sources.versioned import VersionedTable

BUCKETS = 64
#: Batches that a bucket may gather before the index is compacted.
COMPACT_AFTER = 64


def _index_path(path: str, buckets: int) -> str:
    # the number is part of the name: another one finds no index and builds its own
    return f"{tables.index_root(path)}/of_{buckets}"


def _bucketed(pairs: DataFrame, key: str, buckets: int) -> DataFrame:
    return pairs.withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))


def _write(pairs: DataFrame, key: str, folder: str, buckets: int) -> None:
    rows = _bucketed(pairs.where(F.col(key).isNotNull()), key, buckets)
    rows.hint("rebalance", "bucket").write.mode("append").partitionBy("bucket").parquet(folder, compression=shared.CODEC)


def build_index(table: FolderTable | VersionedTable, key: str, buckets: int = BUCKETS) -> None:
    """The index from one scan of the table's keys; it is moved in whole."""
    spark, index = table.spark, _index_path(table.path, buckets)
    staged = f"{index}.__staged"
    shared.delete(spark, staged)
    _write(table.read().select(key, table.partition), key, staged, buckets)
    shared.delete(spark, index)
    shared.rename(spark, staged, index)


def lookup(spark: SparkSession, path: str, batch: DataFrame, partition: str, key: str, buckets: int = BUCKETS) -> DataFrame:
    """``key, partition``: where keys of the batch lie, or have lain. Other buckets are not read."""
    index = _index_path(path, buckets)
    asked = [r.bucket for r in _bucketed(batch.select(key), key, buckets).select("bucket").distinct().collect()]
    there = set(shared.child_names(spark, index))
    wanted = [f"{index}/bucket={b}" for b in sorted(asked) if f"bucket={b}" in there]
    schema = batch.select(key, partition).schema
    if not wanted:
        return spark.createDataFrame([], schema)
    pairs = spark.read.schema(schema).parquet(*wanted)
    n = shared.more_partitions(pairs, batch)
    found = shared.spread(pairs, n, key).join(shared.spread(batch.select(key), n, key), key, "left_semi")
    return found.select(key, partition).distinct()


def _repeated(table: FolderTable | VersionedTable, key: str, buckets: int) -> tuple[DataFrame, DataFrame]:
    """Pairs of the index, and those of keys with several pairs that the table holds.

    The latter are looked up in the partitions that such pairs name, and staged.
    """
    both = [key, table.partition]
    pairs = table.spark.read.parquet(_index_path(table.path, buckets)).select(both)
    dealt = shared.spread(pairs, shared.more_partitions(pairs), key)
    ends = dealt.groupBy(key).agg(F.min(table.partition).alias("first"), F.max(table.partition).alias("last"))
    several = shared.stage(ends.where("first < last").select(key), "several")  # hardly any
    doubtful = shared.stage(pairs.join(several, key, "left_semi").distinct(), "doubtful")
    shared.discard(several)
    days = [r[0] for r in doubtful.select(table.partition).distinct().collect()]
    true = shared.stage(table.read(days).select(both).join(doubtful, both, "left_semi").distinct(), "true")
    single = pairs.distinct().join(doubtful.select(key).distinct(), key, "left_anti")
    return single, true


def compact(table: FolderTable | VersionedTable, key: str, buckets: int = BUCKETS) -> None:
    """Rewrite the index without the pairs that the table doesn't hold; only keys with several can have one."""
    spark, index = table.spark, _index_path(table.path, buckets)
    staged = f"{index}.__staged"
    shared.delete(spark, staged)
    single, true = _repeated(table, key, buckets)
    _write(single.unionByName(true), key, staged, buckets)
    shared.delete(spark, index)
    shared.rename(spark, staged, index)
    shared.discard(true)


def repeats(table: FolderTable | VersionedTable, key: str, buckets: int = BUCKETS) -> int:
    """By how much the partitions' numbers of distinct keys exceed the table's: keys that lie in several of them."""
    _, true = _repeated(table, key, buckets)
    found = true.groupBy(key).agg(F.count(F.lit(1)).alias("n")).agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0))).first()[0]
    shared.discard(true)
    return int(found)


def _gathered(spark: SparkSession, path: str, buckets: int) -> int:
    """Files in the fullest of a few buckets."""
    index = _index_path(path, buckets)
    some = [n for n in shared.child_names(spark, index) if n.startswith("bucket=")][:4]
    return max((len(shared.child_names(spark, f"{index}/{n}")) for n in some), default=0)


def upsert_indexed(
    spark: SparkSession,
    valid: DataFrame,
    path: str,
    key: str = "transaction_id",
    unit: str = "day",
    buckets: int = BUCKETS,
    versioned: bool = False,
    stored: bool = False,
) -> list[date]:
    """``tables.upsert_silver`` whose cost follows the batch; gives the partitions it changed.

    The index names the partitions that may hold an older copy of a key, their key
    columns say which are changed, and only those are read whole and
    rewritten. ``valid`` must hold each key once; null keys replace nothing.
    ``stored`` says that it only filters a stored table, so that it isn't staged.
    ``versioned`` publishes by a pointer, so that no reader sees a half-done upsert.
    """
    partition = tables.UNITS[unit]
    table = (VersionedTable if versioned else FolderTable)(spark, path, partition)
    valid = tables.placed(valid, unit)
    table.settle()
    batch = valid if stored else shared.stage(valid, "batch")
    try:
        schema = batch.schema
        filled = table.filled()
        if filled and not shared.holds_data(spark, _index_path(path, buckets)):
            build_index(table, key, buckets)
        days = {r[0] for r in batch.select(partition).distinct().collect()}
        known = shared.stage(lookup(spark, path, batch, partition, key, buckets), "known")
        may_hold = [r[0] for r in known.select(partition).distinct().collect()]
        replaces = bool(filled and may_hold)
        if replaces:
            days, replaces = tables.changed_partitions(table.read(may_hold, schema), batch, key, partition)
        if days:
            n = shared.more_partitions(known, batch)
            named = shared.spread(batch.select(key, partition), n, key)
            new = named.join(shared.spread(known, n, key), [key, partition], "left_anti") if may_hold else named
            _write(new, key, _index_path(path, buckets), buckets)
            target = table.read(sorted(days), schema)
            table.replace(tables._changed_rows(target, batch, key, partition, days, replaces), sorted(days))
        shared.discard(known)
        if _gathered(spark, path, buckets) > COMPACT_AFTER:
            compact(table, key, buckets)
        return sorted(days)
    finally:
        if not stored:
            shared.discard(batch)
