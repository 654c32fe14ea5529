"""The streaming jobs: tickers, typed diffs, synced books, bars and symbol changes."""

from __future__ import annotations

import json
import logging
from collections.abc import Callable
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidebook.functions import market
from tidebook.operators.bars import ohlcv, partial_bars
from tidebook.operators.changes import audit_rows, flatten_envelopes, rejected_envelopes
from tidebook.sinks import files, tables, topics
from tidebook.sources.wire import RAW_TOPIC, WATERMARK, diff_stream
from tidebook.streaming.arrival import local_sorts
from tidebook.streaming.changelog import changelog_rows
from tidebook.streaming.synced import gaps, synced_rows, synced_tickers
from tidebook.streaming.ticker import letters, ticker_rows, tickers

_LOG = logging.getLogger(__name__)

# Fixed values of the stream jobs.
COMMIT_INTERVAL = "60 seconds"
STATE_TTL_MS = 3_600_000


@dataclass(frozen=True)
class TickerSinks:
    """Where a ticker job writes.  Topics are folders of JSON, or broker topics when ``servers`` is set."""

    silver: str
    ticker_topic: str | None = None
    dead_letters: str | None = None
    servers: str | None = None


@contextmanager
def _held(batch: DataFrame):
    """Keep a micro-batch while it is written, so that its state is not computed once per sink.

    The extra column is needed: a bare micro-batch carries the sort order of the plan it came
    from, whose columns the cache cannot map to its own.
    """
    held = batch.withColumn("_held", F.lit(True)).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield held.drop("_held")
    finally:
        held.unpersist()


def _trigger(writer, available_now: bool, interval: str):
    return writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)


def _publish(messages: DataFrame, target: str | None, servers: str | None, batch: str) -> None:
    if target is None:
        return
    if servers:
        topics.publish(messages, servers, target)
    else:
        topics.publish_files(messages, target, batch)


def _publish_letters(letters_: Callable[[], DataFrame], target: str | None, servers: str | None, batch: str) -> None:
    """Publish dead letters after everything else; a failing target is logged and never stops the job."""
    try:
        _publish(topics.dead_letter_messages(letters_()), target, servers, batch)
    except Exception:  # whatever the target raises
        _LOG.exception("dead letters of batch %s were not written to %s", batch, target)


def _batch_tag(batch: DataFrame, name: str, checkpoint: str, batch_id: int) -> str:
    """Name of a batch, with the id of its checkpoint: a new checkpoint counts batches from 0 again."""
    found = json.loads(files.read_text(batch.sparkSession, f"{checkpoint}/metadata") or "{}")
    return f"{name}-{found.get('id', 'new')}-{batch_id:012d}"


def start_ticker_job(
    raw: DataFrame,
    sinks: TickerSinks,
    checkpoint: str,
    name: str = "ticker",
    processed_ts=None,
    late_seconds: float = market.LATE_SECONDS,
    ttl_ms: int | None = None,
    available_now: bool = False,
    interval: str = COMMIT_INTERVAL,
    topic: str = RAW_TOPIC,
) -> StreamingQuery:
    """Raw records to the silver table, the ticker topic and the dead letters in one query.

    ``name`` identifies the job across restarts; it marks which batches the silver table has.
    """
    if ttl_ms and available_now:
        raise ValueError("state that expires with the clock keeps an available-now run from ending")
    rows = ticker_rows(raw, processed_ts, late_seconds, ttl_ms=ttl_ms, topic=topic)

    def write(batch: DataFrame, batch_id: int) -> None:
        tag = _batch_tag(batch, name, checkpoint, batch_id)
        with _held(batch) as held:
            ticks = tickers(held)
            tables.append_ticks(ticks, sinks.silver, tag)
            _publish(topics.to_messages(ticks), sinks.ticker_topic, sinks.servers, tag)
            _publish_letters(lambda: letters(held), sinks.dead_letters, sinks.servers, tag)

    writer = rows.writeStream.queryName(name).option("checkpointLocation", checkpoint).foreachBatch(write)
    with local_sorts(raw.sparkSession):
        return _trigger(writer, available_now, interval).start()


def start_diffs_job(
    raw: DataFrame,
    path: str,
    checkpoint: str,
    watermark: str = WATERMARK,
    name: str = "diffs",
    available_now: bool = False,
    interval: str = COMMIT_INTERVAL,
) -> StreamingQuery:
    """Raw records to a table of typed diffs, each event once; no book is kept."""

    def write(batch: DataFrame, batch_id: int) -> None:
        tag = _batch_tag(batch, name, checkpoint, batch_id)
        with _held(batch) as held:
            rows = tables.with_event_date(held, "exchange_event_ts")
            tables.append_once(rows, path, tables.TICK_PARTITIONS, ["event_id"], tag)

    writer = (
        diff_stream(raw, watermark)
        .writeStream.queryName(name)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(write)
    )
    return _trigger(writer, available_now, interval).start()


def start_synced_job(
    diffs: DataFrame,
    snapshots: DataFrame,
    silver: str,
    gap_table: str,
    checkpoint: str,
    name: str = "synced",
    depth: int = market.TOP_DEPTH,
    available_now: bool = False,
    interval: str = COMMIT_INTERVAL,
) -> StreamingQuery:
    """Diffs and snapshots to tickers of books started from snapshots, and to a table of gaps."""
    rows = synced_rows(diffs, snapshots, depth)

    def write(batch: DataFrame, batch_id: int) -> None:
        tag = _batch_tag(batch, name, checkpoint, batch_id)
        with _held(batch) as held:
            tables.append_ticks(synced_tickers(held), silver, tag)
            tables.append_once(gaps(held), gap_table, ["exchange", "symbol"], ["kafka_partition", "kafka_offset"], tag)

    writer = rows.writeStream.queryName(name).option("checkpointLocation", checkpoint).foreachBatch(write)
    with local_sorts(diffs.sparkSession):
        return _trigger(writer, available_now, interval).start()


def start_changelog_job(
    raw: DataFrame,
    path: str,
    checkpoint: str,
    name: str = "changelog",
    available_now: bool = False,
    interval: str = COMMIT_INTERVAL,
) -> StreamingQuery:
    """Change envelopes to a changelog table whose old images come from state; rejects are left to the changes job."""
    rows = changelog_rows(audit_rows(flatten_envelopes(raw)))

    def write(batch: DataFrame, batch_id: int) -> None:
        with _held(batch) as held:
            key = ["source_lsn", "kafka_offset", "row_kind"]
            tables.append_once(held, path, ["symbol"], key, _batch_tag(batch, name, checkpoint, batch_id))

    writer = rows.writeStream.queryName(name).option("checkpointLocation", checkpoint).foreachBatch(write)
    return _trigger(writer, available_now, interval).start()


def start_partial_bars_job(
    ticks: DataFrame,
    path: str,
    checkpoint: str,
    bar: str = "1 minute",
    name: str = "partial-bars",
    available_now: bool = False,
    interval: str = COMMIT_INTERVAL,
) -> StreamingQuery:
    """The partial bars of every micro-batch, appended as they come.

    No watermark and no state: a tick of any age is in some partial bar, and ``bars.merge_partials`` of the
    table followed by ``bars.finish_bars`` gives all bars up to now.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        tag = _batch_tag(batch, name, checkpoint, batch_id)
        partials = partial_bars(batch, bar).withColumn("batch", F.lit(tag))
        tables.append_once(partials, path, ["exchange", "symbol"], ["window_start", "batch"], tag)

    writer = ticks.writeStream.queryName(name).option("checkpointLocation", checkpoint).foreachBatch(write)
    return _trigger(writer, available_now, interval).start()


def bars_stream(ticks: DataFrame, interval: str = "1 minute", watermark: str = WATERMARK) -> DataFrame:
    """Bars of a ticker stream; each is emitted once, when the watermark passes its end."""
    return ohlcv(ticks.withWatermark("exchange_event_ts", watermark), interval)


def start_bars_job(
    ticks: DataFrame,
    path: str,
    checkpoint: str,
    interval: str = "1 minute",
    watermark: str = WATERMARK,
    name: str = "bars",
    available_now: bool = False,
    commit: str = COMMIT_INTERVAL,
) -> StreamingQuery:
    def write(batch: DataFrame, batch_id: int) -> None:
        with _held(batch) as held:
            if not held.isEmpty():
                tables.append_bars(held, path)

    bars = bars_stream(ticks, interval, watermark)
    writer = (
        bars.writeStream.queryName(name)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(write)
    )
    return _trigger(writer, available_now, commit).start()


def start_changes_job(
    raw: DataFrame,
    audit_path: str,
    state_path: str,
    checkpoint: str,
    name: str = "changes",
    ingest_ts=None,
    dead_letter_path: str | None = None,
    servers: str | None = None,
    available_now: bool = False,
    interval: str = COMMIT_INTERVAL,
) -> StreamingQuery:
    """Change envelopes to the audit table and the current-state table."""
    flattened = flatten_envelopes(raw, ingest_ts)

    def write(batch: DataFrame, batch_id: int) -> None:
        tag = _batch_tag(batch, name, checkpoint, batch_id)
        with _held(batch) as held:
            audit = audit_rows(held)
            tables.append_audit(audit, audit_path, tag)
            tables.upsert_changes(audit, state_path)
            _publish_letters(lambda: rejected_envelopes(held), dead_letter_path, servers, tag)

    writer = flattened.writeStream.queryName(name).option("checkpointLocation", checkpoint).foreachBatch(write)
    return _trigger(writer, available_now, interval).start()
