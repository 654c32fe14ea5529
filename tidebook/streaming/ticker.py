"""Streaming order book: raw records to tickers, with late and malformed rows beside them."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidebook.functions import levels as lv
from tidebook.functions import market
from tidebook.operators.book import Book
from tidebook.operators.orderbook import QUOTE, finish_ticker
from tidebook.operators.sequence import is_late
from tidebook.schemas import DIFF, names
from tidebook.sources.wire import ERRORS, RAW_TOPIC, dead_letters, parse_diff_events
from tidebook.streaming.arrival import Arrival, in_order

_REJECT_SHARDS = 64
# The state runner renames columns that start with an underscore.
_LEVELS = ["bid_px", "bid_qty", "ask_px", "ask_qty"]
_PLAIN = [c for c in names(DIFF) if c not in ("bids", "asks")]
_CARRIED = [*_PLAIN, "original_payload", "error_type", "error_message"]
_STATE = T.StructType(
    [
        T.StructField("last_id", T.LongType()),
        T.StructField("bid_px", T.ArrayType(T.StringType())),
        T.StructField("bid_qty", T.ArrayType(T.DoubleType())),
        T.StructField("ask_px", T.ArrayType(T.StringType())),
        T.StructField("ask_qty", T.ArrayType(T.DoubleType())),
    ]
)
OUTPUT = T.StructType(
    [DIFF[c] for c in _PLAIN]
    + [T.StructField(c, T.StringType()) for c in ("original_payload", "error_type", "error_message")]
    + [T.StructField(c, T.DoubleType()) for c in QUOTE]
)


class BookProcessor(StatefulProcessor):
    """Keeps the last update id and the book of one instrument.

    The book is read and written once per micro-batch, not once per level.  Of a micro-batch only
    one piece (an Arrow batch) is held at a time, however many rows an instrument has in it.
    """

    def __init__(self, depth: int = market.TOP_DEPTH, ttl_ms: int | None = None):
        self.depth = depth
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("book", _STATE, self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues):
        """Folds the rows piece by piece; ``ticker_rows`` brings them in order of arrival."""
        stored, arrival = None, Arrival()
        for batch in rows:
            rejects = batch["error_type"].notna() & (batch["error_type"] != "late_event")
            if rejects.any():
                yield self._shape(batch[rejects], {})
            batch = batch[~rejects]
            if batch.empty:
                continue
            arrival.check(batch)
            last_id, book = stored or self._load()
            kept, quotes = [], []
            columns = [batch[c].tolist() for c in ("last_update_id", "error_type", *_LEVELS)]
            for position, (update_id, error, *update) in enumerate(zip(*columns)):
                if last_id is not None and update_id <= last_id:
                    continue
                last_id = update_id  # a late diff uses its id but leaves the book alone
                if error == "late_event":
                    kept.append(position)
                    quotes.append((None,) * len(QUOTE))
                    continue
                book.apply(*[part if part is not None else () for part in update])
                quote = book.quote(self.depth)
                if quote is not None:
                    kept.append(position)
                    quotes.append(quote)
            stored = last_id, book
            if kept:
                yield self._shape(batch.iloc[kept], dict(zip(QUOTE, zip(*quotes))))
        if stored:
            self._save(*stored)

    def close(self) -> None:
        pass

    def _shape(self, rows: pd.DataFrame, quotes: dict) -> pd.DataFrame:
        out = rows[_CARRIED].reset_index(drop=True)
        for name in QUOTE:
            out[name] = pd.Series(quotes.get(name, [None] * len(out)), dtype="float64")
        return out

    def _load(self):
        book = Book()
        stored = self.state.get() if self.state.exists() else None
        if stored is None:
            return None, book
        last_id, bid_px, bid_qty, ask_px, ask_qty = stored
        book.apply(bid_px, bid_qty, ask_px, ask_qty)
        return last_id, book

    def _save(self, last_id, book: Book) -> None:
        sides = [list(zip(*side.by_age())) or [(), ()] for side in (book.bids, book.asks)]
        (bid_px, bid_qty), (ask_px, ask_qty) = sides
        self.state.update((int(last_id), list(bid_px), list(bid_qty), list(ask_px), list(ask_qty)))


def tag_records(
    raw: DataFrame,
    processed_ts=None,
    late_seconds: float = market.LATE_SECONDS,
    topic: str = RAW_TOPIC,
) -> DataFrame:
    """Parsed records with ``late_event`` set beside the parse errors; payloads stay only on rejects."""
    parsed = parse_diff_events(raw, processed_ts, topic=topic)
    late = F.col("error_type").isNull() & is_late(late_seconds)
    error = F.when(late, F.lit("late_event")).otherwise(F.col("error_type"))
    message = F.when(late, F.lit(ERRORS["late_event"])).otherwise(F.col("error_message"))
    payload = F.when(late | F.col("error_type").isNotNull(), F.col("original_payload"))
    return parsed.select(
        *names(DIFF), payload.alias("original_payload"), error.alias("error_type"), message.alias("error_message")
    )


def ticker_rows(
    raw: DataFrame,
    processed_ts=None,
    late_seconds: float = market.LATE_SECONDS,
    depth: int = market.TOP_DEPTH,
    ttl_ms: int | None = None,
    topic: str = RAW_TOPIC,
) -> DataFrame:
    """Quotes, late diffs and rejects of a raw stream from one scan; see ``tickers`` and ``letters``.

    Rejects have no instrument, so they travel under numbered shards instead of one null key.
    Start the query within ``arrival.local_sorts``.
    """
    shard = F.when(
        F.col("error_type").isNull() | (F.col("error_type") == "late_event"), F.lit(-1)
    ).otherwise(F.pmod(F.coalesce("kafka_offset", F.lit(0)), F.lit(_REJECT_SHARDS)))
    ready = tag_records(raw, processed_ts, late_seconds, topic).select(
        *_CARRIED,
        lv.prices(F.col("bids")).alias("bid_px"),
        lv.quantities(F.col("bids")).alias("bid_qty"),
        lv.prices(F.col("asks")).alias("ask_px"),
        lv.quantities(F.col("asks")).alias("ask_qty"),
        shard.cast("int").alias("shard"),
    )
    # Levels of rejects may not be numbers; drop them before they are read.
    ready = ready.select(
        *_CARRIED,
        *[F.when(F.col("shard") == -1, F.col(c)).alias(c) for c in _LEVELS],
        "shard",
    )
    key = ["exchange", "symbol", "shard"]
    order = [F.col(c).asc_nulls_last() for c in ("kafka_partition", "kafka_offset")]
    return in_order(ready, key, order).groupBy(*key).transformWithStateInPandas(
        statefulProcessor=BookProcessor(depth, ttl_ms),
        outputStructType=OUTPUT,
        outputMode="Append",
        timeMode="ProcessingTime" if ttl_ms else "None",
    )


def tickers(rows: DataFrame) -> DataFrame:
    return finish_ticker(rows.where(F.col("error_type").isNull() & F.col("best_bid_price").isNotNull()))


def letters(rows: DataFrame) -> DataFrame:
    return dead_letters(rows)
