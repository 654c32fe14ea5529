"""Fixed schemas of every table and message.  No schema is ever inferred."""

from __future__ import annotations

from pyspark.sql import types as T

LEVELS = T.ArrayType(T.ArrayType(T.StringType()))


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields])


_s, _l, _i, _d, _t = (
    T.StringType(),
    T.LongType(),
    T.IntegerType(),
    T.DoubleType(),
    T.TimestampType(),
)

# One record of a topic: decoded payload plus its position.
RAW_RECORD = _struct(("payload", _s), ("kafka_partition", _i), ("kafka_offset", _l))

# Canonical diff event as published on the raw topic.  Times stay text because
# producers send ISO-8601, epoch milliseconds, or an alternate field name.
DIFF_EVENT = _struct(
    ("event_id", _s),
    ("exchange", _s),
    ("symbol", _s),
    ("exchange_event_ts", _s),
    ("event_time", _s),
    ("ingest_ts", _s),
    ("ingest_time", _s),
    ("first_update_id", _s),
    ("last_update_id", _s),
    ("bids", LEVELS),
    ("asks", LEVELS),
)

# Parsed diff, input of every order-book operator.
DIFF = _struct(
    ("event_id", _s),
    ("exchange", _s),
    ("symbol", _s),
    ("exchange_event_ts", _t),
    ("ingest_ts", _t),
    ("processed_ts", _t),
    ("first_update_id", _l),
    ("last_update_id", _l),
    ("bids", LEVELS),
    ("asks", LEVELS),
    ("kafka_topic", _s),
    ("kafka_partition", _i),
    ("kafka_offset", _l),
)

DEPTH_SNAPSHOT = _struct(
    ("exchange", _s), ("symbol", _s), ("last_update_id", _l), ("bids", LEVELS), ("asks", LEVELS)
)

BOOK_TICKER = _struct(
    ("event_id", _s),
    ("exchange", _s),
    ("symbol", _s),
    ("exchange_event_ts", _t),
    ("ingest_ts", _t),
    ("processed_ts", _t),
    ("last_update_id", _l),
    ("first_update_id", _l),
    ("best_bid_price", _d),
    ("best_bid_qty", _d),
    ("best_ask_price", _d),
    ("best_ask_qty", _d),
    ("spread", _d),
    ("mid_price", _d),
    ("imbalance", _d),
    ("kafka_topic", _s),
    ("kafka_partition", _i),
    ("kafka_offset", _l),
)

OHLCV_BAR = _struct(
    ("exchange", _s),
    ("symbol", _s),
    ("window_start", _t),
    ("window_end", _t),
    ("open_price", _d),
    ("high_price", _d),
    ("low_price", _d),
    ("close_price", _d),
    ("volume", _d),
    ("vwap", _d),
    ("tick_count", _l),
    ("first_ts", _t),
    ("last_ts", _t),
)

SYMBOL_CONFIG = _struct(
    ("symbol", _s),
    ("exchange", _s),
    ("status", _s),
    ("base_asset", _s),
    ("quote_asset", _s),
    ("lot_size_min", _d),
    ("lot_size_step", _d),
    ("tick_size", _d),
    ("created_at", _t),
    ("updated_at", _t),
)

# Row image inside a change envelope: timestamps are epoch milliseconds.
SYMBOL_IMAGE = _struct(
    ("symbol", _s),
    ("exchange", _s),
    ("status", _s),
    ("base_asset", _s),
    ("quote_asset", _s),
    ("lot_size_min", _d),
    ("lot_size_step", _d),
    ("tick_size", _d),
    ("created_at", _l),
    ("updated_at", _l),
)

# Change envelope.  The row images stay JSON text (the audit table stores them so).
CDC_ENVELOPE = T.StructType(
    [
        T.StructField("before", _s),
        T.StructField("after", _s),
        T.StructField("source", _struct(("lsn", _l), ("ts_ms", _l), ("txId", _l))),
        T.StructField("op", _s),
        T.StructField("ts_ms", _l),
    ]
)

CDC_BRONZE = _struct(
    ("op", _s),
    ("symbol", _s),
    ("before_json", _s),
    ("after_json", _s),
    ("source_lsn", _l),
    ("source_ts_ms", _l),
    ("source_tx_id", _l),
    ("debezium_ts_ms", _l),
    ("kafka_topic", _s),
    ("kafka_partition", _i),
    ("kafka_offset", _l),
    ("ingest_ts", _t),
)

DEAD_LETTER = _struct(
    ("original_key", _s),
    ("original_payload", _s),
    ("error_type", _s),
    ("error_message", _s),
    ("ingest_ts", _t),
)


def names(schema: T.StructType) -> list[str]:
    return schema.fieldNames()
