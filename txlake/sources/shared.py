"""The shared folder that staged tables live in, and file-system calls on it.

Staged tables cut lineage: once written they survive the loss of any executor,
unlike cached or locally checkpointed blocks.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Bytes of stored rows that one task may sort: compressed, they are some twenty times as much in memory, which an executor's core has.
SORTED_BYTES = 3 << 20
#: How files of tables are compressed; as small as this they cost a third less to write than by the default.
CODEC = "zstd"
#: Folders of local applications that name none.
_LOCAL: dict[str, str] = {}
#: Names of the folders that ``stage`` has made and ``discard`` may delete; no two are alike.
_STAGED: set[str] = set()


def shared_root(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``.

    Where that is unset a local master, as in tests, gets one fresh folder per
    application; on a cluster it is an error. No setting of the session is changed.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if root is None:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        if context.applicationId not in _LOCAL:
            _LOCAL[context.applicationId] = tempfile.mkdtemp(prefix="txlake-")
        root = _LOCAL[context.applicationId]
    return root.rstrip("/")


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that no other run uses."""
    return f"{shared_root(spark)}/txlake/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back."""
    path = fresh_path(df.sparkSession, label)
    _STAGED.add(path.rsplit("/", 1)[1])
    df.write.parquet(path, compression=CODEC)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(staged: DataFrame) -> None:
    """Delete the folder of a table made by ``stage`` that nothing reads any more; other tables stay."""
    spark = staged.sparkSession
    for name in {file.rsplit("/", 2)[-2] for file in staged.inputFiles()} & _STAGED:
        delete(spark, f"{shared_root(spark)}/txlake/{name}")
        _STAGED.discard(name)


def _handle(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs
    where = hadoop.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def stored_bytes(df: DataFrame) -> int:
    """The size of all files that ``df`` is made from; 0 for rows that come from no file."""
    total = 0
    for file in df.inputFiles():
        fs, where = _handle(df.sparkSession, file)
        total += fs.getFileStatus(where).getLen()
    return total


def more_partitions(*frames: DataFrame) -> int | None:
    """Partitions that keep a sort of the frames' rows in memory; None when the session's number does.

    That number is fixed, so without this a sort's share of rows grows with the table until it spills.
    """
    wanted = -(-sum(map(stored_bytes, frames)) // SORTED_BYTES)
    return wanted if wanted > int(frames[0].sparkSession.conf.get("spark.sql.shuffle.partitions")) else None


def spread(df: DataFrame, n: int | None, *keys: str) -> DataFrame:
    """``df`` dealt over ``n`` partitions by ``keys``; as it is without a number."""
    return df if n is None else df.repartition(n, *keys)


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _handle(spark, path)
    return fs.exists(where)


def holds_data(spark: SparkSession, path: str) -> bool:
    """Whether a folder holds anything that a reader would read.

    Committed files say so, not a success marker, which clusters may not write. What a
    job leaves that didn't get to its commit starts with an underscore or a dot.
    """
    return any(not name.startswith(("_", ".")) for name in child_names(spark, path))


def delete(spark: SparkSession, path: str) -> bool:
    fs, where = _handle(spark, path)
    return fs.delete(where, True)


def make_folder(spark: SparkSession, path: str) -> None:
    fs, where = _handle(spark, path)
    fs.mkdirs(where)


def stamp(spark: SparkSession, path: str) -> str:
    """Names and times of what lies directly under a folder; empty when it is missing."""
    fs, where = _handle(spark, path)
    if not fs.exists(where):
        return ""
    return " ".join(sorted(f"{s.getPath().getName()}@{s.getModificationTime()}" for s in fs.listStatus(where)))


def rename(spark: SparkSession, source: str, target: str) -> None:
    """Move a folder; the parent of ``target`` is made when missing."""
    fs, src = _handle(spark, source)
    dst = spark._jvm.org.apache.hadoop.fs.Path(target)
    fs.mkdirs(dst.getParent())
    if not fs.rename(src, dst):
        raise OSError(f"could not move {source} to {target}")


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly under a folder, sorted; empty when the folder is missing."""
    fs, where = _handle(spark, path)
    if not fs.exists(where):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(where))


def read_text(spark: SparkSession, path: str) -> str:
    """A small file, read by the driver."""
    fs, where = _handle(spark, path)
    stream = fs.open(where)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, written by the driver over an older one."""
    fs, where = _handle(spark, path)
    stream = fs.create(where, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def replace_file(spark: SparkSession, source: str, target: str) -> None:
    """Move a file over another one in a single step."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    src, dst = hadoop.Path(source), hadoop.Path(target)
    rename = hadoop.Options.Rename
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    configuration = spark._jsc.hadoopConfiguration()
    hadoop.FileContext.getFileContext(src.getFileSystem(configuration).getUri(), configuration).rename(src, dst, options)
