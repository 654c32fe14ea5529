"""Change-data-capture envelopes: audit rows and current state."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidebook.functions.clock import as_of_column
from tidebook.operators.latest import latest_by
from tidebook.schemas import CDC_BRONZE, CDC_ENVELOPE, SYMBOL_CONFIG, SYMBOL_IMAGE, names
from tidebook.sources.wire import parsed_once

# Fixed values of the envelope format.
OPS = ["r", "c", "u", "d"]
DELETE = "d"
UNKNOWN_SYMBOL = "UNKNOWN"
CDC_TOPIC = "postgres.public.symbol_config"
ERRORS = {
    "tombstone": "record has no value",
    "malformed_json": "payload is not a valid envelope",
    "missing_op": "envelope has no operation code",
    "unknown_op": "operation code is not one of r, c, u, d",
    "empty_payload": "both row images are null",
}
LOG_ORDER = ["source_lsn", "kafka_offset"]


def flatten_envelopes(raw: DataFrame, ingest_ts=None, payload: str = "payload", topic: str = CDC_TOPIC) -> DataFrame:
    """Raw records to audit rows, rejects marked by ``error_type``."""
    fields = T.StructType([*CDC_ENVELOPE.fields, T.StructField("_corrupt", T.StringType())])
    body = F.from_json(F.col(payload), fields, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    df = parsed_once(raw, body, [f"_j_{c}" for c in fields.names])
    image = F.coalesce("_j_after", "_j_before")
    error = (
        F.when(F.col(payload).isNull(), "tombstone")
        .when(F.col("_j__corrupt").isNotNull(), "malformed_json")
        .when(F.coalesce("_j_op", F.lit("")) == "", "missing_op")
        .when(~F.col("_j_op").isin(OPS), "unknown_op")
        .when(image.isNull(), "empty_payload")
    )
    out = df.select(
        F.col("_j_op").alias("op"),
        F.coalesce(F.nullif(F.get_json_object(image, "$.symbol"), F.lit("")), F.lit(UNKNOWN_SYMBOL)).alias("symbol"),
        F.col("_j_before").alias("before_json"),
        F.col("_j_after").alias("after_json"),
        F.coalesce(F.col("_j_source.lsn"), F.lit(0)).alias("source_lsn"),
        F.coalesce(F.col("_j_source.ts_ms"), F.lit(0)).alias("source_ts_ms"),
        F.coalesce(F.col("_j_source.txId"), F.lit(0)).alias("source_tx_id"),
        F.coalesce(F.col("_j_ts_ms"), F.lit(0)).alias("debezium_ts_ms"),
        F.lit(topic).alias("kafka_topic"),
        F.col("kafka_partition"),
        F.col("kafka_offset"),
        as_of_column(ingest_ts).alias("ingest_ts"),
        F.col(payload).alias("original_payload"),
        error.alias("error_type"),
    )
    message = F.lit(None).cast("string")
    for name, text in ERRORS.items():
        message = F.when(F.col("error_type") == name, F.lit(text)).otherwise(message)
    return out.withColumn("error_message", message)


def audit_rows(flattened: DataFrame) -> DataFrame:
    """Accepted events of every operation, nothing filtered: the replay source of the state."""
    return flattened.where(F.col("error_type").isNull()).select(*names(CDC_BRONZE))


def rejected_envelopes(flattened: DataFrame) -> DataFrame:
    return flattened.where(F.col("error_type").isNotNull()).select(
        F.when(F.col("symbol") != UNKNOWN_SYMBOL, F.col("symbol")).alias("original_key"),
        F.coalesce(F.col("original_payload"), F.lit("")).alias("original_payload"),
        "error_type",
        "error_message",
        "ingest_ts",
    )


def changelog(audit: DataFrame) -> DataFrame:
    """Events as changelog rows: insert, update before/after, delete.  An absent old image gives no row."""

    def row(kind: str, image: str):
        return F.when(F.col(image).isNotNull(), F.struct(F.lit(kind).alias("row_kind"), F.col(image).alias("image_json")))

    rows = (
        F.when(F.col("op").isin("r", "c"), F.array(row("INSERT", "after_json")))
        .when(F.col("op") == "u", F.array(row("UPDATE_BEFORE", "before_json"), row("UPDATE_AFTER", "after_json")))
        .otherwise(F.array(row("DELETE", "before_json")))
    )
    return audit.select("symbol", *LOG_ORDER, F.inline(F.array_compact(rows)))


def last_changes(audit: DataFrame) -> DataFrame:
    """The last event per symbol in log order, deletions included."""
    return latest_by(audit.select("symbol", "op", "after_json", *LOG_ORDER), ["symbol"], LOG_ORDER)


def to_config(changes: DataFrame) -> DataFrame:
    """Row images to config rows; epoch milliseconds become timestamps."""
    image = F.from_json("after_json", SYMBOL_IMAGE)
    times = ("created_at", "updated_at")
    return changes.select("symbol", image.alias("_a")).select(
        *[
            F.col("symbol")
            if c == "symbol"
            else (F.timestamp_millis(f"_a.{c}") if c in times else F.col(f"_a.{c}")).alias(c)
            for c in names(SYMBOL_CONFIG)
        ]
    )


def current_state(audit: DataFrame) -> DataFrame:
    """State after replaying all changes in log order: last image per symbol, deleted ones gone.

    Only the last image of a symbol is parsed.  The old image is never needed, so an update
    without one is kept.
    """
    return to_config(last_changes(audit).where(F.col("op") != DELETE))
