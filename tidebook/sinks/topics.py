"""Keyed JSON messages and dead letters for a broker topic, or JSON files in its place."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidebook.functions.market import routing_key

# Fixed value: the timestamp format of messages (ISO-8601, UTC).
ISO_MILLIS = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"


def to_messages(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """``key`` (exchange#symbol, which fixes the partition and so the order) and JSON ``value``."""
    body = F.struct(*(columns or df.columns))
    return df.select(
        routing_key(F.col("exchange"), F.col("symbol")).alias("key"),
        F.to_json(body, {"timestampFormat": ISO_MILLIS}).alias("value"),
    )


def dead_letter_messages(letters: DataFrame) -> DataFrame:
    return letters.select(
        F.col("original_key").alias("key"),
        F.to_json(F.struct(*letters.columns), {"timestampFormat": ISO_MILLIS}).alias("value"),
    )


def publish(messages: DataFrame, servers: str, topic: str) -> None:
    messages.write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save()


def publish_files(messages: DataFrame, path: str, batch: str) -> None:
    """One folder per batch; a retried batch replaces its folder."""
    messages.write.mode("overwrite").json(f"{path}/batch={batch}")
