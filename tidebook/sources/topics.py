"""Topic scans: a message broker where its connector is deployed, JSON or Parquet files elsewhere."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidebook.schemas import RAW_RECORD

# A topic reader starts at the oldest record and reads a bounded slice per micro-batch.
EARLIEST = "earliest"
# Admission limits of a micro-batch, which bound what one task of the book fold holds.  None lifts them.
MAX_OFFSETS = 1_000_000
MAX_FILES = 64


def read_topic(
    spark: SparkSession,
    servers: str,
    topic: str,
    streaming: bool = True,
    starting_offsets: str = EARLIEST,
    ending_offsets: str | None = None,
    max_offsets_per_trigger: int | None = MAX_OFFSETS,
) -> DataFrame:
    """Broker records as ``key, value, topic, kafka_partition, kafka_offset, record_ts``."""
    reader = (spark.readStream if streaming else spark.read).format("kafka")
    reader = (
        reader.option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
    )
    if ending_offsets and not streaming:
        reader = reader.option("endingOffsets", ending_offsets)
    if max_offsets_per_trigger and streaming:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    return reader.load().select(
        "key",
        "value",
        "topic",
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
        F.col("timestamp").alias("record_ts"),
    )


def offsets_json(topic: str, ranges: list[tuple[int, int, int | None]]) -> tuple[str, str]:
    """``(startingOffsets, endingOffsets)`` option texts for ``(partition, start, end)`` ranges.

    An open end, ``None`` or the largest offset, becomes the connector's "latest" marker.
    """
    latest, open_end = -1, 2**63 - 1  # fixed values: the connector's marker, and ours
    start = {topic: {str(p): s for p, s, _ in ranges}}
    end = {topic: {str(p): latest if e in (None, open_end) else e for p, _, e in ranges}}
    return json.dumps(start), json.dumps(end)


def stream_files(
    spark: SparkSession,
    path: str,
    schema=RAW_RECORD,
    file_format: str = "parquet",
    max_files_per_trigger: int | None = MAX_FILES,
) -> DataFrame:
    """A folder of files read as a stream, in file-time order."""
    reader = spark.readStream.schema(schema).format(file_format)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def decode_records(records: DataFrame) -> DataFrame:
    """Broker records to ``payload, kafka_partition, kafka_offset``; tombstones (null value) are skipped."""
    return records.where(F.col("value").isNotNull()).select(
        F.decode(F.col("value").cast("binary"), "UTF-8").alias("payload"),
        "kafka_partition",
        "kafka_offset",
    )
