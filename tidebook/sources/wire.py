"""JSON payloads to typed diffs, with rejects kept beside the good rows.

Each parser returns every input row with ``error_type``/``error_message`` set on
the rejects, so that one scan feeds both outputs (``accepted`` and ``dead_letters``).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidebook.functions.clock import as_of_column, epoch_ms
from tidebook.functions.levels import well_formed
from tidebook.functions.market import event_key, routing_key
from tidebook.schemas import BOOK_TICKER, DIFF, DIFF_EVENT, LEVELS, names

# Fixed values of the wire protocol and topics.
DEPTH_UPDATE = "depthUpdate"
RAW_TOPIC = "market.raw.orderbook"
WATERMARK = "5 seconds"
WIRE_FIELDS = {
    "e": "_event_type",
    "E": "_event_ms",
    "s": "_symbol",
    "U": "_first",
    "u": "_last",
    "b": "_bids",
    "a": "_asks",
}

ERRORS = {
    "tombstone": "record has no value",
    "malformed_json": "payload is not valid JSON of the expected shape",
    "missing_field": "a required field is absent",
    "bad_number": "an update id is not an integer",
    "bad_levels": "a level is not a pair of numbers",
    "bad_timestamp": "event time cannot be read",
    "late_event": "event lags processing time by more than the threshold",
}


def parsed_once(raw: DataFrame, body: Column, columns: list[str]) -> DataFrame:
    """Add the fields of struct ``body`` as ``columns``.

    The struct goes through a one-row generator: the optimizer would otherwise push the filters
    on parsed fields below the projection and repeat the JSON parse for every field they use.
    """
    return raw.select("*", F.inline(F.array(body)).alias(*columns))


def _parsed(raw: DataFrame, schema: T.StructType, payload: str) -> DataFrame:
    with_corrupt = T.StructType([*schema.fields, T.StructField("_corrupt", T.StringType())])
    body = F.from_json(
        F.col(payload), with_corrupt, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    )
    return parsed_once(raw, body, [f"_j_{c}" for c in with_corrupt.names])


def _first_error(*checks: tuple[Column, str]) -> Column:
    chosen = F.lit(None).cast("string")
    for condition, name in reversed(checks):
        chosen = F.when(condition, F.lit(name)).otherwise(chosen)
    return chosen


def _message(error_type: Column) -> Column:
    text = F.lit(None).cast("string")
    for name, message in ERRORS.items():
        text = F.when(error_type == name, F.lit(message)).otherwise(text)
    return text


def _blank_to_null(column: Column) -> Column:
    return F.nullif(column, F.lit(""))


def parse_diff_events(
    raw: DataFrame,
    processed_ts=None,
    payload: str = "payload",
    topic: str = RAW_TOPIC,
) -> DataFrame:
    """Raw topic records to diffs.

    ``raw`` has ``payload, kafka_partition, kafka_offset`` and optionally ``processed_ts``;
    otherwise ``processed_ts`` is the argument, by default the current time.
    """
    processed = F.col("processed_ts") if "processed_ts" in raw.columns else as_of_column(processed_ts)
    df = _parsed(raw, DIFF_EVENT, payload)
    event_ms = epoch_ms(F.coalesce(_blank_to_null(F.col("_j_exchange_event_ts")), _blank_to_null(F.col("_j_event_time"))))
    ingest_ms = epoch_ms(
        F.coalesce(_blank_to_null(F.col("_j_ingest_ts")), _blank_to_null(F.col("_j_ingest_time"))), default=processed
    )
    last_id = F.col("_j_last_update_id").try_cast("long")
    first_id = F.coalesce(F.col("_j_first_update_id"), F.lit("0")).try_cast("long")
    error = _first_error(
        (F.col(payload).isNull(), "tombstone"),
        (F.col("_j__corrupt").isNotNull(), "malformed_json"),
        (
            F.col("_j_exchange").isNull() | F.col("_j_symbol").isNull() | F.col("_j_last_update_id").isNull(),
            "missing_field",
        ),
        (last_id.isNull() | first_id.isNull(), "bad_number"),
        (~(well_formed(F.col("_j_bids")) & well_formed(F.col("_j_asks"))), "bad_levels"),
        (event_ms.isNull(), "bad_timestamp"),
    )
    out = df.select(
        F.coalesce(F.col("_j_event_id"), F.lit("")).alias("event_id"),
        F.col("_j_exchange").alias("exchange"),
        F.col("_j_symbol").alias("symbol"),
        F.timestamp_millis(event_ms).alias("exchange_event_ts"),
        F.timestamp_millis(ingest_ms).alias("ingest_ts"),
        processed.alias("processed_ts"),
        first_id.alias("first_update_id"),
        last_id.alias("last_update_id"),
        F.coalesce(F.col("_j_bids"), F.array()).alias("bids"),
        F.coalesce(F.col("_j_asks"), F.array()).alias("asks"),
        F.lit(topic).alias("kafka_topic"),
        F.col("kafka_partition"),
        F.col("kafka_offset"),
        F.col(payload).alias("original_payload"),
        error.alias("error_type"),
    )
    return out.withColumn("error_message", _message(F.col("error_type")))


def parse_wire_diffs(
    raw: DataFrame, exchange: str, ingest_ts=None, payload: str = "payload", topic: str = RAW_TOPIC
) -> DataFrame:
    """Exchange wire messages to diffs.  Other event types are filtered out, bad ones are rejects."""
    processed = F.col("processed_ts") if "processed_ts" in raw.columns else as_of_column(ingest_ts)
    # Keys differ only in case (e/E, u/U), which struct fields cannot: read the object as a map.
    as_map = raw.select("*", F.explode(F.array(F.from_json(F.col(payload), "map<string,string>"))).alias("_m"))
    fields = F.col("_m")
    values = [
        F.from_json(F.try_element_at(fields, F.lit(c)), LEVELS) if c in "ba" else F.try_element_at(fields, F.lit(c))
        for c in WIRE_FIELDS
    ]
    df = parsed_once(as_map, F.struct(*values), list(WIRE_FIELDS.values()))
    event_ms = epoch_ms(F.col("_event_ms"))
    first_id, last_id = F.col("_first").try_cast("long"), F.col("_last").try_cast("long")
    symbol = F.lower("_symbol")
    missing = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in WIRE_FIELDS.values()])
    error = _first_error(
        (F.col(payload).isNull(), "tombstone"),
        (fields.isNull(), "malformed_json"),
        (missing, "missing_field"),
        (last_id.isNull() | first_id.isNull(), "bad_number"),
        (~(well_formed(F.col("_bids")) & well_formed(F.col("_asks"))), "bad_levels"),
        (event_ms.isNull(), "bad_timestamp"),
    )
    out = df.select(
        event_key(F.lit(exchange), symbol, last_id).alias("event_id"),
        F.lit(exchange).alias("exchange"),
        symbol.alias("symbol"),
        F.timestamp_millis(event_ms).alias("exchange_event_ts"),
        processed.alias("ingest_ts"),
        processed.alias("processed_ts"),
        first_id.alias("first_update_id"),
        last_id.alias("last_update_id"),
        F.col("_bids").alias("bids"),
        F.col("_asks").alias("asks"),
        F.lit(topic).alias("kafka_topic"),
        F.col("kafka_partition"),
        F.col("kafka_offset"),
        F.col(payload).alias("original_payload"),
        error.alias("error_type"),
        "_event_type",
    ).withColumn("error_message", _message(F.col("error_type")))
    other_event = F.col("error_type").isNull() & (F.col("_event_type") != DEPTH_UPDATE)
    return out.where(~other_event).drop("_event_type")


def diff_stream(raw: DataFrame, watermark: str = WATERMARK, **options) -> DataFrame:
    """Accepted diffs, typed, with an event-time watermark; of an event delivered again within it the first stays.

    JVM only, with one state row an event that goes when the watermark passes it: the source of jobs that fold
    no books.  Events behind the watermark are dropped.
    """
    typed = accepted(parse_diff_events(raw, **options)).withWatermark("exchange_event_ts", watermark)
    return typed.dropDuplicatesWithinWatermark(["event_id"])


def parse_ticker_messages(raw: DataFrame, payload: str = "payload") -> DataFrame:
    """Ticker messages of the normalised topic back to ticker rows; unreadable ones are ignored."""
    body = F.from_json(F.col(payload), BOOK_TICKER, {"mode": "PERMISSIVE"})
    rows = raw.select(F.inline(F.array(body)))
    return rows.where(F.col("exchange").isNotNull() & F.col("symbol").isNotNull())


def ticker_stream(raw: DataFrame, watermark: str = WATERMARK) -> DataFrame:
    return parse_ticker_messages(raw).withWatermark("exchange_event_ts", watermark)


def accepted(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("error_type").isNull()).select(*names(DIFF))


def dead_letters(parsed: DataFrame, payload: str = "original_payload") -> DataFrame:
    """Rejects as dead-letter envelopes ``original_key, original_payload, error_type, error_message, ingest_ts``."""
    key = F.when(
        F.col("exchange").isNotNull() & F.col("symbol").isNotNull(),
        routing_key(F.col("exchange"), F.col("symbol")),
    )
    return parsed.where(F.col("error_type").isNotNull()).select(
        key.alias("original_key"),
        F.coalesce(F.col(payload), F.lit("")).alias("original_payload"),
        "error_type",
        "error_message",
        F.col("processed_ts").alias("ingest_ts"),
    )
