"""Every operator as a query over the given tables.  ``oracles`` holds the SQL twins."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidebook.functions.clock import epoch_ms, parse_instant
from tidebook.operators import bars, changes, orderbook, quality, sequence
from tidebook.plans import backfill, marts, replay, serving, staging
from tidebook.session import prepare, shared_dir
from tidebook.sinks import tables, topics
from tidebook.sources import adapters, wire
from tidebook.sources.tables import recent, time_range
from tidebook.sources.topics import decode_records
from tidebook.streaming import jobs

Query = Callable[[SparkSession, str], DataFrame]
AS_OF = adapters.AS_OF
FRESH, WARN = 1000, 2000
QUERIES: dict[str, Query] = {}


def naive(df: DataFrame) -> DataFrame:
    """Timestamps without zone, as the comparison engine has them."""
    return df.select(
        *[
            F.col(f.name).cast("timestamp_ntz").alias(f.name) if isinstance(f.dataType, T.TimestampType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def query(function: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return naive(function(prepare(spark), sf_dir))

    QUERIES[function.__name__] = run
    return function


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    """Sums of doubles depend on the order of addition in the last bits."""
    return df.withColumns({c: F.round(c, 6) for c in columns})


def _bars(df: DataFrame) -> DataFrame:
    return _rounded(df, "volume", "vwap")


# Bars


@query
def ohlcv_bars(spark, d):
    return _bars(bars.ohlcv(adapters.book_ticker(spark, d), "1 hour"))


@query
def ohlcv_minute_bars(spark, d):
    return _bars(bars.ohlcv(adapters.book_ticker(spark, d)))


@query
def ohlcv_close_fallback(spark, d):
    return _bars(bars.ohlcv(adapters.book_ticker(spark, d), "1 minute", vwap_mode="close"))


@query
def ohlcv_backfill(spark, d):
    ticks = adapters.book_ticker(spark, d)
    return _bars(backfill.backfill_bars(ticks, date(2024, 1, 5), date(2024, 1, 20), "1 hour", "avg"))


@query
def bar_rollup(spark, d):
    return _bars(bars.roll_up(bars.ohlcv(adapters.book_ticker(spark, d)), "6 hours"))


def _parts(spark, d, interval):
    """Partial bars of ticks dealt into seven parts by a hash."""
    ticks = adapters.book_ticker(spark, d).withColumn("part", F.pmod(F.xxhash64("event_id"), F.lit(7)))
    return bars.partial_bars(ticks, interval, by=("part",))


def _exact_bars(df: DataFrame) -> DataFrame:
    """Sums of merged bars are exact, so they are compared to more places than sums of doubles."""
    return df.withColumns({c: F.round(c, 9) for c in ("volume", "vwap")})


@query
def bar_merge(spark, d):
    """Parts merged in two groups, then those: the same bars as from all ticks at once."""
    half = (F.col("part") % 2).alias("half")
    groups = bars.merge_partials(_parts(spark, d, "1 hour").select("*", half), by=("half",))
    return _exact_bars(bars.finish_bars(bars.merge_partials(groups)))


# Staging and marts


@query
def stg_book_ticker(spark, d):
    return staging.stg_book_ticker(adapters.book_ticker(spark, d))


@query
def stg_ohlcv(spark, d):
    return _bars(staging.stg_ohlcv(bars.ohlcv(adapters.book_ticker(spark, d), "1 hour")))


@query
def stg_symbol_config(spark, d):
    return staging.stg_symbol_config(_state(spark, d))


@query
def mart_ohlcv(spark, d):
    return _bars(staging.mart_ohlcv(bars.ohlcv(adapters.book_ticker(spark, d), "6 hours")))


@query
def spread_metrics(spark, d):
    return marts.spread_metrics(adapters.book_ticker(spark, d))


@query
def imbalance_signal(spark, d):
    return marts.signed(marts.imbalance_signal(adapters.book_ticker(spark, d)))


@query
def freshness_status(spark, d):
    return marts.freshness_status(adapters.book_ticker(spark, d), AS_OF, FRESH, WARN)


@query
def exchange_health(spark, d):
    return marts.exchange_health(adapters.book_ticker(spark, d), AS_OF, FRESH, WARN)


def _liquidity(spark, d):
    return marts.liquidity(adapters.book_ticker(spark, d), AS_OF, FRESH, WARN)


def _health(spark, d):
    return marts.exchange_health(adapters.book_ticker(spark, d), AS_OF, FRESH, WARN)


@query
def mart_liquidity(spark, d):
    return _liquidity(spark, d)


@query
def mart_liquidity_joined(spark, d):
    ticks = adapters.book_ticker(spark, d)
    return marts.join_liquidity(
        marts.spread_metrics(ticks),
        marts.imbalance_signal(ticks),
        marts.freshness_status(ticks, AS_OF, FRESH, WARN),
    )


@query
def sla_breaches(spark, d):
    return marts.sla_breaches(adapters.book_ticker(spark, d), AS_OF, 1500)


@query
def lag_rollup(spark, d):
    return marts.lag_rollup(_health(spark, d), AS_OF)


@query
def symbol_counts(spark, d):
    return marts.symbol_counts(adapters.book_ticker(spark, d))


@query
def silver_scan(spark, d):
    rows = time_range(adapters.book_ticker(spark, d), "2024-01-10", "2024-01-12", symbol="view")
    return rows.select("kafka_partition", "kafka_offset")


@query
def silver_scan_stored(spark, d):
    """The same scan over tickers stored by date; only the folders in the range are read."""
    path = f"{shared_dir(spark, 'silver')}/ticks"
    tables.append_ticks(adapters.book_ticker(spark, d), path, "load")
    rows = time_range(spark.read.parquet(path), "2024-01-10", "2024-01-12", symbol="view")
    return rows.select("kafka_partition", "kafka_offset")


@query
def recent_rows(spark, d):
    return recent(adapters.book_ticker(spark, d), 600, AS_OF).select("event_id", "exchange_event_ts")


# Serving


def _minute_bars(spark, d):
    return bars.ohlcv(adapters.book_ticker(spark, d))


def _hour_bars(spark, d):
    return bars.ohlcv(adapters.book_ticker(spark, d), "1 hour")


@query
def liquidity_snapshot(spark, d):
    return serving.liquidity_snapshot(_liquidity(spark, d))


@query
def spread_for_symbol(spark, d):
    return serving.spread_for(_liquidity(spark, d), "View")


@query
def liquidity_for_symbol(spark, d):
    return serving.liquidity_for(_liquidity(spark, d), "Click")


@query
def recent_bars(spark, d):
    return _bars(serving.recent_bars(_minute_bars(spark, d), AS_OF))


@query
def recent_bars_ranked(spark, d):
    return _bars(serving.recent_bars(_hour_bars(spark, d), AS_OF, hours=720, n=60, by_exchange=True))


@query
def bars_with_count(spark, d):
    return _bars(serving.bars_with_count(serving.recent_bars(_minute_bars(spark, d), AS_OF, hours=48)))


@query
def newest_bars(spark, d):
    return _bars(serving.newest_bars(_minute_bars(spark, d), "view", 10, AS_OF))


@query
def historical_bars(spark, d):
    rows = serving.historical_bars(
        _hour_bars(spark, d), "VIEW", "2024-01-03 00:00:00", "2024-01-25 12:00:00", 300
    )
    return _bars(rows)


@query
def lag_list(spark, d):
    return serving.lag_list(_health(spark, d), AS_OF)


@query
def symbol_list(spark, d):
    return serving.symbol_list(_state(spark, d))


@query
def gauge_feed(spark, d):
    return serving.gauge_feed(_liquidity(spark, d), _health(spark, d))


@query
def audit_listing(spark, d):
    return serving.audit_listing(_audit(spark, d), 25)


@query
def recent_counts(spark, d):
    ticks = adapters.book_ticker(spark, d)
    return serving.recent_counts(
        {"book_ticker": (ticks, "exchange_event_ts"), "ohlcv_1m": (bars.ohlcv(ticks), "window_start")}, AS_OF
    )


# Parsing


def _level_text(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.array_join(F.flatten(c), ",") for c in ("bids", "asks")})


@query
def parse_events(spark, d):
    return _level_text(wire.accepted(wire.parse_diff_events(adapters.raw_payloads(spark, d))))


@query
def parse_wire(spark, d):
    return _level_text(wire.accepted(wire.parse_wire_diffs(adapters.wire_payloads(spark, d), "sim")))


@query
def dlq_rejects(spark, d):
    return wire.dead_letters(wire.parse_diff_events(adapters.raw_payloads(spark, d)))


@query
def wire_rejects(spark, d):
    rejects = wire.dead_letters(wire.parse_wire_diffs(adapters.wire_payloads(spark, d), "sim"))
    return rejects.select("original_key", "error_type", "ingest_ts")


@query
def epoch_coercion(spark, d):
    """Times spelled as ISO text, milliseconds, fractional milliseconds, seconds or nonsense."""
    rows = adapters.topic_records(spark, d)
    ms = F.unix_millis("record_ts")
    text = (
        F.when(F.col("kafka_offset") % 5 == 0, F.date_format("record_ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"))
        .when(F.col("kafka_offset") % 5 == 1, ms.cast("string"))
        .when(F.col("kafka_offset") % 5 == 2, F.concat(ms.cast("string"), F.lit(".75")))
        .when(F.col("kafka_offset") % 5 == 3, F.date_format("record_ts", "yyyy-MM-dd'T'HH:mm:ss+00:00"))
        .otherwise(F.lit("not a time"))
    )
    seconds = F.unix_seconds("record_ts").cast("string")
    return rows.select(
        "kafka_offset",
        epoch_ms(text).alias("event_ms"),
        epoch_ms(text, default=F.col("record_ts")).alias("event_ms_or_now"),
        parse_instant(seconds).alias("from_seconds"),
    )


@query
def decode_topic(spark, d):
    records = adapters.raw_payloads(spark, d).withColumn("value", F.col("payload").cast("binary"))
    return decode_records(records)


@query
def keyed_messages(spark, d):
    """Ticker messages, read back from their JSON to compare by column."""
    ticks = adapters.book_ticker(spark, d)
    messages = topics.to_messages(ticks)
    body = F.from_json("value", "event_id string, exchange_event_ts string, mid_price double, kafka_offset long")
    return messages.select("key", body.alias("_b")).select("key", "_b.*")


@query
def ticker_topic_source(spark, d):
    """Ticker messages parsed back to all their columns."""
    messages = topics.to_messages(adapters.book_ticker(spark, d))
    return wire.parse_ticker_messages(messages.withColumnRenamed("value", "payload"))


# Sequence rules


@query
def monotone_dedup(spark, d):
    kept = sequence.monotone_dedup(adapters.sequenced_diffs(spark, d))
    return kept.select("exchange", "symbol", "last_update_id", "kafka_offset")


@query
def late_routing(spark, d):
    tagged = sequence.tag_late(adapters.depth_diffs(spark, d))
    return tagged.select("event_id", "symbol", "lag_s", "error_type")


@query
def sequence_classes(spark, d):
    rows = sequence.classify_sequence(adapters.sequenced_diffs(spark, d))
    return rows.select("symbol", "kafka_offset", "last_seen_id", "is_stale", "is_gap", "segment_id")


@query
def gap_report(spark, d):
    return sequence.gap_report(adapters.sequenced_diffs(spark, d))


# Order book


def _ticker(df: DataFrame) -> DataFrame:
    return _rounded(df, "imbalance")


@query
def order_book_ticker(spark, d):
    return _ticker(orderbook.book_ticker(adapters.depth_diffs(spark, d)))


@query
def order_book_quiet(spark, d):
    """Many quiet instruments whose diffs lie far apart in one partition."""
    return _ticker(orderbook.book_ticker(adapters.quiet_diffs(spark, d), span=256))


@query
def replay_idempotent(spark, d):
    """Tickers of a topic in which rows were delivered twice: the second delivery changes nothing."""
    return _ticker(orderbook.book_ticker(adapters.sequenced_diffs(spark, d)))


@query
def snapshot_init(spark, d):
    return _ticker(
        orderbook.book_from_snapshots(adapters.depth_snapshots(spark, d), adapters.sequenced_diffs(spark, d))
    )


@query
def book_imbalance_top5(spark, d):
    return _ticker(orderbook.image_metrics(adapters.depth_snapshots(spark, d)))


# Change data capture


def _flattened(spark, d, stream=False):
    return changes.flatten_envelopes(adapters.change_envelopes(spark, d, stream), AS_OF)


def _audit(spark, d):
    return changes.audit_rows(_flattened(spark, d))


def _state(spark, d):
    return changes.current_state(_audit(spark, d))


def _audit_columns(df: DataFrame) -> DataFrame:
    """Row images compared by two of their fields instead of their text."""
    pick = {
        "before_status": F.get_json_object("before_json", "$.status"),
        "after_tick_size": F.get_json_object("after_json", "$.tick_size").cast("double"),
    }
    return df.withColumns(pick).drop("before_json", "after_json")


@query
def cdc_bronze(spark, d):
    return _audit_columns(_audit(spark, d))


@query
def cdc_rejects(spark, d):
    return changes.rejected_envelopes(_flattened(spark, d)).select("original_key", "error_type", "error_message")


@query
def cdc_current_state(spark, d):
    return _state(spark, d)


@query
def cdc_changelog(spark, d):
    rows = changes.changelog(_audit(spark, d))
    status = F.get_json_object("image_json", "$.status").alias("status")
    return rows.select("symbol", "source_lsn", "row_kind", status)


@query
def materialized_marts(spark, d):
    """Bars stored as a table that a view exposes by name."""
    out = shared_dir(spark, "models")
    stored = tables.as_table(staging.mart_ohlcv(bars.ohlcv(adapters.book_ticker(spark, d), "6 hours")), out, ["symbol"])
    tables.as_view(stored, "mart_ohlcv")
    return _bars(spark.table("mart_ohlcv"))


@query
def live_marts(spark, d):
    """Liquidity and health as views over stored tickers, whose "now" is the time of each read."""
    ticks = tables.as_table(adapters.book_ticker(spark, d), f"{shared_dir(spark, 'live')}/ticks")
    tables.as_view(marts.liquidity(ticks), "live_liquidity")
    tables.as_view(marts.exchange_health(ticks), "live_health")
    return spark.sql("""
        SELECT l.exchange, l.symbol, l.latest_ts, l.spread_bps, l.market_signal, l.freshness_status,
               h.health_score, h.staleness_seconds >= 86400 AS stale_for_days
        FROM live_liquidity l JOIN live_health h USING (exchange, symbol)
    """)


# Replay


def _request(**options):
    return replay.ReplayRequest("2024-01-10 00:00:00", "2024-01-12 06:00:00", **options)


def _scope(spark, d):
    return adapters.ticks_with_unknown_lineage(spark, d), adapters.topic_records(spark, d)


@query
def offset_ranges(spark, d):
    request = _request()
    return replay.offset_ranges(_scope(spark, d)[0], request.start, request.end)


@query
def offset_ranges_for_symbol(spark, d):
    request = _request()
    return replay.offset_ranges(_scope(spark, d)[0], request.start, request.end, "VIEW")


@query
def time_offset_ranges(spark, d):
    return replay.time_offset_ranges(adapters.topic_records(spark, d), "2024-01-10", "2024-01-12 06:00:00")


@query
def time_offset_ranges_open(spark, d):
    return replay.time_offset_ranges(adapters.topic_records(spark, d), "2024-01-20", "2024-02-20")


@query
def replay_rows(spark, d):
    return replay.replay_rows(*_scope(spark, d), _request())[0]


@query
def replay_rows_for_symbol(spark, d):
    return replay.replay_rows(*_scope(spark, d), _request(symbol="VIEW"))[0]


@query
def replay_fallback(spark, d):
    """No ticker has lineage, so the ranges come from record times."""
    ticks, records = _scope(spark, d)
    unknown = ticks.withColumns({"kafka_partition": F.lit(-1), "kafka_offset": F.lit(-1).cast("long")})
    rows, _, source = replay.replay_rows(unknown, records, _request())
    return rows.withColumn("offset_source", F.lit(source))


@query
def replay_capped(spark, d):
    """The first events in partition order; the cap is the feature."""
    return replay.replay_rows(*_scope(spark, d), _request(max_events=300))[0]


@query
def replay_stats(spark, d):
    ticks, records = _scope(spark, d)
    request = _request(dry_run=True)
    rows, ranges, source = replay.replay_rows(ticks, records, request)
    stats = replay.replay_stats(rows, ranges, request, source)
    return stats.withColumn("partitions_replayed", F.array_join("partitions_replayed", ","))


# Quality


@query
def replay_stats_for_symbol(spark, d):
    """A symbol filter leaves a partition without rows; its range still counts as replayed."""
    ticks, records = _scope(spark, d)
    request = _request(dry_run=True, symbol="VIEW")
    rows, ranges, source = replay.replay_rows(ticks, records.where("kafka_partition <> 3 or key not like '%view'"), request)
    stats = replay.replay_stats(rows, ranges, request, source)
    return stats.withColumn("partitions_replayed", F.array_join("partitions_replayed", ","))


@query
def dq_report(spark, d):
    """All model rules, with the status rule finding its planted violations."""
    ticks, state = adapters.book_ticker(spark, d), _state(spark, d)
    models = {
        "stg_book_ticker": staging.stg_book_ticker(ticks),
        "stg_ohlcv_1m": staging.stg_ohlcv(bars.ohlcv(ticks, "1 hour")),
        "stg_symbol_config": staging.stg_symbol_config(state),
        "int_spread_metrics": marts.spread_metrics(ticks),
        "int_order_book_imbalance": marts.imbalance_signal(ticks),
        "int_freshness_status": marts.freshness_status(ticks, AS_OF),
        "mart_ohlcv": staging.mart_ohlcv(bars.ohlcv(ticks, "1 hour")),
        "mart_liquidity": marts.liquidity(ticks, AS_OF),
        "mart_exchange_health": marts.exchange_health(ticks, AS_OF),
    }
    reports = [quality.check(df, name, quality.model_rules(name)) for name, df in models.items()]
    out = reports[0]
    for report in reports[1:]:
        out = out.unionByName(report)
    return out


@query
def dq_observed(spark, d):
    """All model rules, counted while the models are stored; later models are made from stored ones."""
    out = shared_dir(spark, "models")
    reports = []

    def stored(df: DataFrame, name: str) -> DataFrame:
        rows, report = quality.write_checked(df, f"{out}/{name}", name, quality.model_rules(name))
        reports.append(report)
        return rows

    # Stored with all columns: bars need the ids that the staged projection leaves out.
    ticks = stored(adapters.book_ticker(spark, d), "stg_book_ticker")
    hours = stored(staging.stg_ohlcv(bars.ohlcv(ticks, "1 hour")), "stg_ohlcv_1m")
    stored(staging.mart_ohlcv(hours), "mart_ohlcv")
    stored(staging.stg_symbol_config(_state(spark, d)), "stg_symbol_config")
    stored(marts.liquidity(ticks, AS_OF), "mart_liquidity")
    stored(marts.spread_metrics(ticks), "int_spread_metrics")
    stored(marts.imbalance_signal(ticks), "int_order_book_imbalance")
    stored(marts.freshness_status(ticks, AS_OF), "int_freshness_status")
    stored(marts.exchange_health(ticks, AS_OF), "mart_exchange_health")
    return reduce(DataFrame.unionByName, reports)


@query
def dq_violations(spark, d):
    """Rules with something to find: nulls, bounds, repeated values, too few rows."""
    ticks = adapters.ticks_with_unknown_lineage(spark, d).withColumn(
        "lineage", F.nullif(F.col("kafka_partition"), F.lit(-1))
    )
    rules = [
        quality.Rule("not_null", "lineage"),
        quality.Rule("between", "best_bid_price", low=150, high=400),
        quality.Rule("between", "best_bid_qty", low=1),
        quality.Rule("unique", "event_id"),
        quality.Rule("unique", "lineage"),
        quality.Rule("accepted_values", "symbol", values=["view", "click"]),
        quality.Rule("row_count", low=10**9),
    ]
    return quality.check(ticks, "book_ticker", rules)


@query
def dq_recent(spark, d):
    ticks = adapters.book_ticker(spark, d)
    now = quality.check_recent(ticks, "book_ticker", "exchange_event_ts", "2024-01-30 23:00:00", minutes=600)
    never = quality.check_recent(bars.ohlcv(ticks), "ohlcv_1m", "last_ts", "2024-03-01 00:00:00")
    return now.unionByName(never)


@query
def source_freshness(spark, d):
    ticks = adapters.book_ticker(spark, d)
    return quality.source_freshness(
        {"book_ticker": (ticks, "ingest_ts"), "ohlcv_1m": (bars.ohlcv(ticks), "last_ts")}, AS_OF, 2, 5
    )


# Streams: the given tables read as streams, run to the end, results read back


def _finish(stream) -> None:
    stream.awaitTermination()


@query
def stream_ohlcv(spark, d):
    out = shared_dir(spark, "bars")
    ticks = adapters.book_ticker(spark, d, stream=True)
    _finish(jobs.start_bars_job(ticks, f"{out}/table", f"{out}/state", "1 hour", available_now=True))
    return _bars(spark.read.parquet(f"{out}/table"))


@query
def stream_bar_merge(spark, d):
    """Partial bars appended by a stream without a watermark, merged when read."""
    out = shared_dir(spark, "partials")
    ticks = adapters.book_ticker(spark, d, stream=True)
    _finish(jobs.start_partial_bars_job(ticks, f"{out}/table", f"{out}/state", "1 hour", available_now=True))
    return _exact_bars(bars.finish_bars(bars.merge_partials(spark.read.parquet(f"{out}/table"))))


@query
def stream_changelog(spark, d):
    """Old images from state, for envelopes that have none."""
    out = shared_dir(spark, "changelog")
    raw = adapters.keyed_envelopes(spark, d, stream=True)
    _finish(jobs.start_changelog_job(raw, f"{out}/table", f"{out}/state", available_now=True))
    image = F.from_json("image_json", "status string, tick_size double")
    return spark.read.parquet(f"{out}/table").select("symbol", "source_lsn", "row_kind", image.alias("_i")).select(
        "symbol", "source_lsn", "row_kind", "_i.status", "_i.tick_size"
    )


@query
def stream_bars_retried(spark, d):
    """The stream's bars, then all of them once more as a retried batch brings them."""
    out = shared_dir(spark, "bars")
    ticks = adapters.book_ticker(spark, d, stream=True)
    _finish(jobs.start_bars_job(ticks, f"{out}/table", f"{out}/state", "1 hour", available_now=True))
    tables.append_bars(spark.read.parquet(f"{out}/table").drop("event_date"), f"{out}/table")
    return _bars(spark.read.parquet(f"{out}/table"))


@query
def stream_typed_source(spark, d):
    """Raw diffs delivered twice, as a typed stream in which each event is once.

    The watermark is longer than the table's time, so that no event is late.
    """
    out = shared_dir(spark, "diffs")
    raw, again = (adapters.raw_payloads(spark, d, stream=True) for _ in range(2))
    _finish(
        jobs.start_diffs_job(raw.unionByName(again), f"{out}/table", f"{out}/state", "3650 days", available_now=True)
    )
    return _level_text(spark.read.parquet(f"{out}/table").drop("event_date"))


def _ticker_job(spark, d) -> str:
    out = shared_dir(spark, "ticker")
    raw = adapters.raw_payloads(spark, d, stream=True)
    sinks = jobs.TickerSinks(f"{out}/silver", f"{out}/topic", f"{out}/dlq")
    _finish(jobs.start_ticker_job(raw, sinks, f"{out}/state", available_now=True))
    return out


@query
def stream_ticker(spark, d):
    return _ticker(spark.read.parquet(f"{_ticker_job(spark, d)}/silver").drop("event_date"))


@query
def stream_dead_letters(spark, d):
    messages = spark.read.schema("key string, value string").json(f"{_ticker_job(spark, d)}/dlq")
    body = F.from_json("value", "error_type string, error_message string, ingest_ts string")
    return messages.select("key", body.alias("_b")).select("key", "_b.*")


@query
def stream_topic(spark, d):
    messages = spark.read.schema("key string, value string").json(f"{_ticker_job(spark, d)}/topic")
    body = F.from_json("value", "event_id string, exchange_event_ts string, mid_price double")
    return messages.select("key", body.alias("_b")).select("key", "_b.*")


def _synced_job(spark, d) -> str:
    """Snapshots are a table of their own, read as a second stream beside the diffs."""
    out = shared_dir(spark, "synced")
    images = adapters.depth_snapshots(spark, d)
    images.write.parquet(f"{out}/images")
    snapshots = spark.readStream.schema(images.schema).parquet(f"{out}/images")
    diffs = adapters.sequenced_diffs(spark, d, stream=True)
    _finish(
        jobs.start_synced_job(
            diffs, snapshots, f"{out}/silver", f"{out}/gaps", f"{out}/state", available_now=True
        )
    )
    return out


@query
def stream_snapshot_init(spark, d):
    return _ticker(spark.read.parquet(f"{_synced_job(spark, d)}/silver").drop("event_date"))


@query
def stream_gap_report(spark, d):
    return spark.read.parquet(f"{_synced_job(spark, d)}/gaps").drop("status")


def _changes_job(spark, d) -> str:
    out = shared_dir(spark, "changes")
    raw = adapters.change_envelopes(spark, d, stream=True)
    _finish(
        jobs.start_changes_job(
            raw, f"{out}/audit", f"{out}/config", f"{out}/state", ingest_ts=AS_OF, available_now=True
        )
    )
    return out


@query
def stream_cdc_bronze(spark, d):
    return _audit_columns(spark.read.parquet(f"{_changes_job(spark, d)}/audit"))


@query
def stream_cdc_state(spark, d):
    return tables.read_state(spark, f"{_changes_job(spark, d)}/config")


# Table writes


@query
def overwrite_idempotent(spark, d):
    """Bars written whole, then a date range recomputed twice: the table stays as it was."""
    path = f"{shared_dir(spark, 'backfill')}/bars"
    ticks = adapters.book_ticker(spark, d)
    backfill.run_backfill(ticks, path, date(2024, 1, 1), date(2024, 1, 31), "1 hour")
    for _ in range(2):
        backfill.run_backfill(ticks, path, date(2024, 1, 10), date(2024, 1, 12), "1 hour")
    return _bars(spark.read.parquet(path))


@query
def compaction(spark, d):
    """Tickers appended in slices, compacted: the same rows in one file per partition."""
    path = f"{shared_dir(spark, 'compact')}/ticks"
    days = tables.with_event_date(adapters.book_ticker(spark, d), "exchange_event_ts")
    ticks = days.withColumn("event_date", F.trunc("event_date", "month"))
    for _, keep in (("odd", "kafka_offset % 2 = 1"), ("even", "kafka_offset % 2 = 0")):
        ticks.where(keep).write.mode("append").partitionBy("exchange", "symbol", "event_date").parquet(path)
    tables.compact(spark, path, ["exchange", "symbol", "event_date"])
    left = tables.small_file_folders(spark, path).count()
    return spark.read.parquet(path).drop("event_date").withColumn("small_folders", F.lit(left))
