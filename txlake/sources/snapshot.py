"""Verified copies of lakehouse tables, and their restore."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txlake.sources import shared

_MANIFEST = "_manifest"
_MANIFEST_DDL = "table STRING, rows BIGINT, checksum DECIMAL(38,0), mixed BIGINT"


def fingerprint(df: DataFrame) -> DataFrame:
    """Row count and two order-free checksums over all columns; one pass, no shuffle of rows."""
    row_hash = F.xxhash64(*[F.col(c) for c in sorted(df.columns)])
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(row_hash.cast("decimal(20,0)")), F.lit(0))
        .cast("decimal(38,0)")
        .alias("checksum"),
        F.coalesce(F.bit_xor(row_hash), F.lit(0)).cast("long").alias("mixed"),
    )


def inventory(spark: SparkSession, path: str) -> DataFrame:
    """Data files of a table with size and time; contents are not read."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .load(path)
    )
    return files.select("path", "length", "modificationTime")


def _signature(df: DataFrame) -> tuple:
    return tuple(fingerprint(df).first())


def _signatures(spark: SparkSession, tables: dict[str, str]) -> dict[str, tuple]:
    """Fingerprint per table: a handful of rows, one scan of each table."""
    return {name: _signature(spark.read.parquet(path)) for name, path in tables.items()}


def snapshot_tables(
    spark: SparkSession, tables: dict[str, str], destination: str, writers_paused: bool
) -> DataFrame:
    """Copy tables (name to path) and write a manifest of their fingerprints.

    Refuses running writers, a name without a folder, only empty tables, and an
    existing destination; of several tables, empty ones are left out. The
    manifest comes last and only when neither files nor rows changed during the
    copy, so a copy without one is not a snapshot. Checkpoints are left out:
    only table folders are copied.
    """
    if not writers_paused:
        raise ValueError("writers_paused must be true: a table that is written to cannot be copied as one state")
    if shared.child_names(spark, destination):
        raise ValueError(f"{destination} already holds files")
    absent = sorted(name for name, path in tables.items() if not shared.exists(spark, path))
    if absent:
        raise ValueError(f"no folder for: {', '.join(absent)}; nothing was copied")
    held = {
        name: _signature(inventory(spark, path))
        for name, path in tables.items()
        if shared.holds_data(spark, path)
    }
    filled = {name: tables[name] for name, files in held.items() if files[0] > 0}
    if not filled:
        raise ValueError("every named table is empty")
    for name, path in filled.items():
        spark.read.parquet(path).write.parquet(f"{destination}/{name}", compression=shared.CODEC)
    taken = _signatures(spark, filled)
    for name, path in filled.items():
        if held[name] != _signature(inventory(spark, path)):
            raise ValueError(f"{name} was written to while it was copied; the copy has no manifest")
    if taken != _signatures(spark, {name: f"{destination}/{name}" for name in filled}):
        raise ValueError("rows of a copy are not those of its table; the copy has no manifest")
    lines = [(name, *signature) for name, signature in taken.items()]
    manifest = spark.createDataFrame(lines, _MANIFEST_DDL)
    manifest.coalesce(1).write.parquet(f"{destination}/{_MANIFEST}")
    return manifest


def verify_snapshot(spark: SparkSession, directory: str) -> list[str]:
    """Names of the tables in a snapshot; an error when any differs from the manifest."""
    if not shared.child_names(spark, f"{directory}/{_MANIFEST}"):
        raise ValueError("not a complete snapshot: manifest missing")
    manifest = spark.read.schema(_MANIFEST_DDL).parquet(f"{directory}/{_MANIFEST}")
    # one row per table of the lakehouse
    listed = {row["table"]: tuple(row)[1:] for row in manifest.collect()}
    if not listed:
        raise ValueError("snapshot manifest is empty")
    missing = [n for n in listed if not shared.child_names(spark, f"{directory}/{n}")]
    if missing:
        raise ValueError(f"snapshot lacks tables: {', '.join(sorted(missing))}")
    if listed != _signatures(spark, {n: f"{directory}/{n}" for n in listed}):
        raise ValueError("snapshot differs from its manifest")
    return sorted(listed)


def restore_tables(
    spark: SparkSession, directory: str, target: str, partitions: dict[str, str] | None = None
) -> list[str]:
    """Write a snapshot's tables under ``target``, which must be empty.

    Every table is verified before the first write. ``partitions`` names the
    partition column of the tables that have one.
    """
    names = verify_snapshot(spark, directory)
    if shared.child_names(spark, target):
        raise ValueError("restore target is not empty")
    for name in names:
        rows = spark.read.parquet(f"{directory}/{name}")
        column = (partitions or {}).get(name)
        if column:
            writer = rows.hint("rebalance", column).write.partitionBy(column)
        else:
            writer = rows.write
        writer.parquet(f"{target}/{name}", compression=shared.CODEC)
    return names
