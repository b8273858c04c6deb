"""Partitioned tables that readers always see whole: versioned folders and a pointer.

A publish writes each changed partition to a folder of its own, lists all folders of
the table in a new manifest, and then moves a small pointer file to that manifest with
one rename that replaces the old pointer. Whoever opens the table follows the pointer:
before the rename it is the old table, afterwards the new one. Folders that no
manifest of interest names are deleted by ``vacuum``, not by the publish, so a query
that has started goes on reading what it opened. One writer at a time.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from txlake.sources import shared
from txlake.sources.tables import clustered

VERSION = "_version"
_POINTER = "current"


@dataclass(frozen=True)
class VersionedTable:
    """A table under ``path``, cut by the date column ``partition``."""

    spark: SparkSession
    path: str
    partition: str

    def _manifest(self, number: int) -> str:
        return f"{self.path}/manifests/{number:012d}.json"

    def version(self) -> int:
        """The number of the current version; 0 before the first publish."""
        pointer = f"{self.path}/{_POINTER}"
        return int(shared.read_text(self.spark, pointer)) if shared.exists(self.spark, pointer) else 0

    def versions(self) -> list[int]:
        """Versions that can be opened, the current one last; a manifest without the pointer was cut short."""
        now = self.version()
        names = shared.child_names(self.spark, f"{self.path}/manifests")
        return sorted(n for n in (int(x.split(".")[0]) for x in names if x.endswith(".json")) if n <= now)

    def _listed(self, version: int | None = None) -> dict:
        number = self.version() if version is None else version
        if number == 0:
            return {"folders": {}, "schema": None}
        if not shared.exists(self.spark, self._manifest(number)):
            raise ValueError(f"{self.path} has no version {number}")
        return json.loads(shared.read_text(self.spark, self._manifest(number)))

    def filled(self) -> bool:
        return bool(self._listed()["folders"])

    def values(self) -> list[date]:
        return sorted(map(date.fromisoformat, self._listed()["folders"]))

    def settle(self) -> None:
        """Nothing to finish: what didn't get to its pointer isn't part of the table."""

    def read(self, days: Sequence[date] | None = None, schema: StructType | None = None, version: int | None = None) -> DataFrame:
        """The table, or some partitions of it, as one version; later publishes don't change the answer."""
        listed = self._listed(version)
        schema = schema or (StructType.fromJson(listed["schema"]) if listed["schema"] else None)
        if schema is None:
            raise ValueError(f"{self.path} holds no version")
        wanted = None if days is None else {d.isoformat() for d in days}
        folders = [f for day, f in sorted(listed["folders"].items()) if wanted is None or day in wanted]
        if not folders:
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.schema(schema).option("basePath", f"{self.path}/data")
        return rows.parquet(*[f"{self.path}/data/{f}" for f in folders]).select(*schema.fieldNames())

    def replace(self, rows: DataFrame, days: Sequence[date], arrange: Callable[[DataFrame], DataFrame] | None = None) -> int:
        """Put ``rows`` in the place of some partitions, those without rows go; gives the new version."""
        spark, listed, now = self.spark, self._listed(), self.version()
        made = uuid.uuid4().hex
        staged = f"{self.path}/staged/{made}"
        (arrange or clustered)(rows).write.partitionBy(self.partition).parquet(staged, compression=shared.CODEC)
        prefix = f"{self.partition}="
        filled = [n for n in shared.child_names(spark, staged) if n.startswith(prefix)]
        asked = {d.isoformat() for d in days}
        if strange := {n.removeprefix(prefix) for n in filled} - asked:
            raise ValueError(f"rows of partitions that are not replaced: {', '.join(sorted(strange))}")
        folders = {day: f for day, f in listed["folders"].items() if day not in asked}
        for name in filled:
            folder = f"{name}/{VERSION}={made}"
            shared.rename(spark, f"{staged}/{name}", f"{self.path}/data/{folder}")
            folders[name.removeprefix(prefix)] = folder
        shared.delete(spark, staged)
        manifest = {"folders": folders, "schema": rows.schema.jsonValue()}
        shared.write_text(spark, self._manifest(now + 1), json.dumps(manifest))
        shared.write_text(spark, f"{self.path}/{_POINTER}.{made}", str(now + 1))
        shared.replace_file(spark, f"{self.path}/{_POINTER}.{made}", f"{self.path}/{_POINTER}")
        return now + 1

    def vacuum(self, keep: int = 1) -> int:
        """Delete what the last ``keep`` versions don't need, once no reader has an older one open; gives the folders deleted."""
        spark = self.spark
        known = self.versions()
        kept, gone = known[-keep:], known[:-keep]
        needed = {f for n in kept for f in self._listed(n)["folders"].values()}
        deleted = 0
        for name in shared.child_names(spark, f"{self.path}/data"):
            for inner in shared.child_names(spark, f"{self.path}/data/{name}"):
                if f"{name}/{inner}" not in needed:
                    deleted += shared.delete(spark, f"{self.path}/data/{name}/{inner}")
        for number in gone:
            shared.delete(spark, self._manifest(number))
        shared.delete(spark, f"{self.path}/staged")
        for name in shared.child_names(spark, self.path):
            if name.startswith(f"{_POINTER}."):
                shared.delete(spark, f"{self.path}/{name}")
        return deleted

    def register(self, view: str) -> None:
        """A temp view of the current version; call again to see a later one."""
        self.read().createOrReplaceTempView(view)
