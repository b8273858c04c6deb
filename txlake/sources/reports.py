"""Report tables as JSON, appended per run; a report that is not there reads as no rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txlake.schemas import DRIFT_METRICS_DDL, QUALITY_CHECKS_DDL, QUALITY_METRICS_DDL
from txlake.sources import shared

SCHEMAS = {
    "quality_metrics": QUALITY_METRICS_DDL,
    "quality_checks": QUALITY_CHECKS_DDL,
    "drift_metrics": DRIFT_METRICS_DDL,
}


def _location(root: str, kind: str, run_id: str | None = None) -> str:
    base = f"{root}/{kind}"
    return base if run_id is None else f"{base}/run={run_id}"


def write_report(report: DataFrame, root: str, kind: str, run_id: str) -> None:
    """Write one run's report rows; writing the same run again replaces them."""
    lines = report.withColumn("run_id", F.lit(run_id)).select(*_names(kind))
    # nulls are written out, so that a missing figure differs from one not measured
    lines.write.mode("overwrite").option("ignoreNullFields", "false").json(
        _location(root, kind, run_id)
    )


def read_report(
    spark: SparkSession, root: str, kind: str, run_id: str | None = None
) -> DataFrame:
    """Rows of one run, or of all; damaged lines come back as nulls, never as an error."""
    path = _location(root, kind, run_id)
    if not shared.child_names(spark, path):
        return spark.createDataFrame([], SCHEMAS[kind])
    rows = spark.read.schema(SCHEMAS[kind]).option("recursiveFileLookup", "true").json(path)
    return rows if run_id is None else rows.withColumn("run_id", F.lit(run_id))


def _names(kind: str) -> list[str]:
    return [column.split()[0] for column in SCHEMAS[kind].split(", ")]
