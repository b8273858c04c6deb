"""Message stream to the append-only bronze table, exactly once by checkpoint."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from txlake.operators.bronze import build_bronze_frame
from txlake.schemas import envelope_schema


def read_kafka_stream(
    spark: SparkSession,
    bootstrap_servers: str,
    topic: str,
    starting_offsets: str = "earliest",
    max_offsets_per_trigger: int | None = None,
) -> DataFrame:
    """Subscribe to a topic. Needs the Kafka connector on the class path."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
        .option("failOnDataLoss", "false")
    )
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    return reader.load()


def read_file_stream(
    spark: SparkSession,
    path: str,
    file_format: str = "parquet",
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """The same six envelope columns from files that arrive in a folder."""
    reader = spark.readStream.format(file_format).schema(envelope_schema())
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def apply_trigger(writer: DataStreamWriter, trigger: str) -> DataStreamWriter:
    """``availableNow``/``available_now``/``once`` drain what is there; else an interval."""
    if trigger in ("availableNow", "available_now", "once"):
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=trigger)


def write_bronze(
    bronze: DataFrame,
    path: str,
    checkpoint: str,
    trigger: str = "availableNow",
    table_format: str = "parquet",
) -> StreamingQuery:
    """Append bronze rows, partitioned by ``ingestion_date``.

    The checkpoint and the sink's own commit log make a restart add only what
    the last run had not committed.
    """
    writer = (
        bronze.writeStream.format(table_format)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .partitionBy("ingestion_date")
    )
    return apply_trigger(writer, trigger).start(path)


def run_bronze(
    source: DataFrame, path: str, checkpoint: str, trigger: str = "availableNow"
) -> StreamingQuery:
    """Source stream to bronze table; waits when the trigger drains and ends."""
    query = write_bronze(build_bronze_frame(source), path, checkpoint, trigger)
    if trigger in ("availableNow", "available_now", "once"):
        query.awaitTermination()
    return query


def batch_sizes(query: StreamingQuery) -> list[tuple[int, int]]:
    """(batch, rows read) of the batches that read any, as the query's progress tells; it keeps the last hundred."""
    sizes = {p["batchId"]: p["numInputRows"] for p in query.recentProgress if p["numInputRows"] > 0}
    return sorted(sizes.items())
