"""Table writes and the streaming jobs.  Streams must equal their batch twins."""

from __future__ import annotations

import json
import os
import re
from datetime import date

import pytest
from helpers import at, diff, diffs, quotes_of, random_diffs, sequential_quotes, tick, ticks
from pyspark.sql import functions as F
from test_inputs import _envelope, _image, _raw

from tidebook.operators.bars import ohlcv
from tidebook.operators.changes import audit_rows, current_state, flatten_envelopes
from tidebook.plans.backfill import run_backfill
from tidebook.schemas import BOOK_TICKER, RAW_RECORD
from tidebook.sinks import tables, topics
from tidebook.sources.tables import recent, time_range
from tidebook.sources.topics import stream_files
from tidebook.streaming import jobs
from tidebook.streaming.ticker import BookProcessor


def _rows(df):
    return sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=repr)


def _day_ticks(spark, days=3, per_day=5):
    day = 86_400
    return ticks(spark, [tick(s, d * day + 30 * i, 100.0 + i, u=d * 100 + i) for s in "ab" for d in range(days) for i in range(per_day)])


def test_backfill_replaces_only_its_dates(spark, folder):
    path, df = f"{folder}/bars", _day_ticks(spark)
    run_backfill(df, path, date(2024, 1, 1), date(2024, 1, 4))
    before = _rows(spark.read.parquet(path))
    for _ in range(2):
        run_backfill(df, path, date(2024, 1, 2), date(2024, 1, 3))
    assert _rows(spark.read.parquet(path)) == before
    corrected = df.withColumn("mid_price", F.col("mid_price") + 1000)
    run_backfill(corrected, path, date(2024, 1, 2), date(2024, 1, 3))
    low = {r[0]: r[1] for r in spark.read.parquet(path).groupBy(F.col("event_date").cast("string")).agg(F.min("low_price")).collect()}
    assert low == {"2024-01-01": 100.0, "2024-01-02": 1100.0, "2024-01-03": 100.0}


def test_stored_bars_stay(spark, folder):
    """A bar is emitted once: appending again, even with another value, leaves the stored one."""
    path, df = f"{folder}/bars", _day_ticks(spark)
    bars = ohlcv(df)
    tables.append_bars(bars.where("window_start < '2024-01-01 00:01:00'"), path)
    tables.append_bars(bars, path)
    changed = bars.where("symbol = 'a' and window_start = '2024-01-02 00:00:00'").withColumn("volume", F.lit(77.0))
    tables.append_bars(changed, path)
    assert _rows(spark.read.parquet(path).drop("event_date")) == _rows(bars)
    run_backfill(df.withColumn("best_bid_qty", F.lit(77.0)), path, date(2024, 1, 2), date(2024, 1, 3))
    assert spark.read.parquet(path).where("volume >= 77").count() > 0


def _scan_filters(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.split("\n") if "PartitionFilters" in line]


def test_reads_and_key_checks_are_pruned_by_date(spark, folder):
    path, df = f"{folder}/ticks", _day_ticks(spark)
    tables.append_ticks(df, path, "a")
    stored = spark.read.parquet(path)
    for scan in (time_range(stored, at(0), at(60)), recent(stored, 10, at(86_400))):
        assert all("event_date" in line.split("PartitionFilters")[1].split("]")[0] for line in _scan_filters(scan))
    assert time_range(stored, at(0), at(60)).count() == 2 * 2
    day = tables.with_event_date(df.where("exchange_event_ts >= '2024-01-02' and exchange_event_ts < '2024-01-03'"), "exchange_event_ts")
    checked = tables.without_stored(day, path, tables.TICK_PARTITIONS, tables.TICK_KEY)
    assert any("2024-01-02" in line or "19724" in line for line in _scan_filters(checked)) and checked.isEmpty()


def test_compaction_that_fails_names_its_copy(spark, folder, monkeypatch):
    from pyspark.sql import DataFrameWriter

    path, df = f"{folder}/t", _slices(spark, folder, "t")
    parquet = DataFrameWriter.parquet

    def failing(writer, target, *args, **options):
        if target == path:
            raise OSError("no space")
        return parquet(writer, target, *args, **options)

    monkeypatch.setattr(DataFrameWriter, "parquet", failing)
    with pytest.raises(RuntimeError) as caught:
        tables.compact(spark, path, tables.TICK_PARTITIONS)
    staged = str(caught.value).split(" are in ")[1]
    assert _rows(spark.read.parquet(staged).drop("_shard").withColumn("event_date", F.to_date("event_date"))) == _rows(df)
    monkeypatch.setattr(DataFrameWriter, "parquet", parquet)
    tables.compact(spark, path, tables.TICK_PARTITIONS)
    assert _rows(spark.read.parquet(path)) == _rows(df)


def test_compaction_into_several_files_of_closed_dates_only(spark, folder):
    path, df = f"{folder}/t", _slices(spark, folder, "t")
    size = tables.file_sizes(spark, path).groupBy("folder").agg(F.sum("bytes")).first()[1]
    found = tables.compact(spark, path, tables.TICK_PARTITIONS, target_bytes=size // 2, before=date(2024, 1, 3))
    assert found.count() == 4 and found.agg(F.min("needed_files")).first()[0] >= 2
    assert _rows(spark.read.parquet(path)) == _rows(df)
    with pytest.raises(ValueError):
        tables.compact(spark, path, tables.TICK_PARTITIONS, before=date(9999, 1, 1))


def test_compaction_writes_the_files_that_each_folder_needs(spark, folder):
    """Also beside a folder that needs more; a task of the overwrite has the rows of one file."""
    path = f"{folder}/t"
    rows = spark.range(6000).selectExpr("'x' exchange", "if(id < 5000, 'big', concat('s', id % 5)) symbol", "date'2024-01-01' event_date", "rand(1) v")
    for i in range(12):
        rows.where(f"pmod(hash(v), 12) = {i}").coalesce(1).write.mode("append").partitionBy(*tables.TICK_PARTITIONS).parquet(path)
    wanted = {r["folder"]: r["needed_files"] for r in tables.compact(spark, path, tables.TICK_PARTITIONS, target_bytes=12_000).collect()}
    assert len(wanted) == 6 and len(set(wanted.values())) == 2
    files = spark.read.parquet(path).groupBy("symbol", "_metadata.file_path").count().collect()
    left = {f: sum(f"/symbol={f.split("symbol=")[1].split("/")[0]}/" in r["file_path"] for r in files) for f in wanted}
    assert left == wanted
    tasks = {re.search(r"part-(\d+)", f["file_path"]).group(1) for f in files}
    assert len(tasks) == len(files)
    assert _rows(spark.read.parquet(path).select("v")) == _rows(rows.select("v"))


def test_registered_tables_are_compacted(spark, folder):
    path, df = f"{folder}/book", _slices(spark, folder, "book")
    assert tables.compact_all(spark, {"book_ticker": path}) == {"book_ticker": 6}
    assert _rows(spark.read.parquet(path)) == _rows(df)
    with pytest.raises(KeyError):
        tables.compact_all(spark, {"other": path})


def _slices(spark, folder, name):
    df = tables.with_event_date(_day_ticks(spark), "exchange_event_ts")
    for i in range(4):
        df.where(f"last_update_id % 4 = {i}").coalesce(1).write.mode("append").partitionBy(*tables.TICK_PARTITIONS).parquet(f"{folder}/{name}")
    return df


def test_dead_letters_never_stop_the_job(spark, folder, monkeypatch):
    def broken(*args):
        raise OSError("no space")

    rows = random_diffs(5, n=40, late=False)
    from pyspark.sql import types as T

    schema = T.StructType([*RAW_RECORD.fields, T.StructField("processed_ts", T.TimestampType())])
    records = [(_payload(r), 0, r[12], r[5]) for r in rows] + [("{", 0, 999, at(0))]
    _put(spark.createDataFrame(records, schema), f"{folder}/in", 0)
    monkeypatch.setattr(topics, "dead_letter_messages", broken)
    sinks = jobs.TickerSinks(f"{folder}/silver", dead_letters=f"{folder}/dlq")
    jobs.start_ticker_job(_stream(spark, f"{folder}/in", schema), sinks, f"{folder}/state", available_now=True).awaitTermination()
    assert quotes_of(spark.read.schema(BOOK_TICKER).parquet(f"{folder}/silver")) == sequential_quotes(rows)


def test_a_retried_batch_adds_nothing(spark, folder):
    path, df = f"{folder}/ticks", _day_ticks(spark)
    tables.append_ticks(df.where("symbol = 'a'"), path, "job-1")
    tables.append_ticks(df.where("symbol = 'b' and last_update_id < 100"), path, "job-2")  # died half way
    tables.append_ticks(df.where("symbol = 'b'"), path, "job-2")
    assert _rows(spark.read.parquet(path).drop("event_date")) == _rows(df)


def test_state_versions(spark, folder):
    def batch(*payloads):
        return audit_rows(flatten_envelopes(_raw(spark, payloads), at(0)))

    path = f"{folder}/config"
    tables.upsert_changes(batch(_envelope("c", after=_image("A"), lsn=1), _envelope("c", after=_image("B"), lsn=2)), path)
    for _ in range(2):  # the second run is a retry
        tables.upsert_changes(batch(_envelope("d", before=_image("A"), lsn=9), _envelope("u", after=_image("B", "BREAK"), lsn=8)), path)
    tables.upsert_changes(batch(_envelope("u", after=_image("A"), lsn=5)), path)  # older than the deletion
    assert [(r["symbol"], r["status"]) for r in tables.read_state(spark, path).collect()] == [("B", "BREAK")]
    for version in range(3, 7):
        tables.upsert_changes(batch(_envelope("u", after=_image("B", f"S{version}"), lsn=10 + version)), path)
    assert len(tables.complete_versions(spark, path)) <= 4
    assert tables.read_state(spark, path).first()["status"] == "S6"
    # A new checkpoint counts its batches from 0 again; the newest state is still built upon.
    tables.upsert_changes(batch(_envelope("u", after=_image("B", "S9"), lsn=90)), path)
    assert [r["status"] for r in tables.read_state(spark, path).where("symbol = 'B'").collect()] == ["S9"]
    os.makedirs(f"{path}/version={99:020d}")  # unfinished
    assert tables.read_state(spark, path).first()["status"] == "S9"


def _state_files(folder):
    return {
        os.path.join(top, name) for top, _, names in os.walk(folder) for name in names if name.endswith(".parquet")
    }


def test_only_touched_buckets_of_the_state_are_written(spark, folder):
    def batch(*payloads):
        return audit_rows(flatten_envelopes(_raw(spark, payloads), at(0)))

    path = f"{folder}/config"
    symbols = [f"s{i}" for i in range(40)]
    tables.upsert_changes(batch(*[_envelope("c", after=_image(s), lsn=i + 1) for i, s in enumerate(symbols)]), path)
    before, held = _state_files(path), tables.state_buckets(spark, path)
    for lsn in (100, 101, 102, 103):
        tables.upsert_changes(batch(_envelope("u", after=_image("s7", f"S{lsn}"), lsn=lsn)), path)
    now = tables.state_buckets(spark, path)
    moved = {b for b in held if now[b] != held[b]}
    assert len(moved) == 1 and set(now) == set(held) and len(held) > 10
    left = {f for f in before if not any(f"/bucket={b}/" in f for b in moved)}
    assert left <= _state_files(path) and len(_state_files(path)) <= len(before) + 3
    state = {r["symbol"]: r["status"] for r in tables.read_state(spark, path).collect()}
    assert set(state) == set(symbols) and state["s7"] == "S103"
    tables.upsert_changes(batch(), path)  # nothing to do
    assert tables.state_buckets(spark, path) == now
    tables.upsert_changes(batch(), f"{folder}/none")
    assert tables.read_state(spark, f"{folder}/none").isEmpty()


def test_compaction(spark, folder):
    path = f"{folder}/t able"
    df = tables.with_event_date(_day_ticks(spark), "exchange_event_ts").withColumn("symbol", F.concat("symbol", F.lit("/x +%")))
    for i in range(4):
        df.where(f"last_update_id % 4 = {i}").coalesce(1).write.mode("append").partitionBy("exchange", "symbol", "event_date").parquet(path)
    before = _rows(spark.read.parquet(path))
    assert tables.small_file_folders(spark, path).count() == 6
    found = tables.compact(spark, path, ["exchange", "symbol", "event_date"])
    assert found.count() == 6 and found.agg(F.max("needed_files")).first()[0] == 1
    assert _rows(spark.read.parquet(path)) == before
    assert tables.file_sizes(spark, path).groupBy("folder").count().agg(F.max("count")).first()[0] == 1
    assert tables.compact(spark, path, ["exchange", "symbol", "event_date"]).isEmpty()


def test_messages(spark):
    row = topics.to_messages(ticks(spark, [tick("btc", 1.5, 100.0)])).first()
    body = json.loads(row["value"])
    assert row["key"] == "x#btc" and body["exchange_event_ts"] == "2024-01-01T00:00:01.500Z" and body["mid_price"] == 100.0


# Streams


def _payload(row):
    return json.dumps(
        {
            "event_id": row[0],
            "exchange": row[1],
            "symbol": row[2],
            "exchange_event_ts": row[3].strftime("%Y-%m-%dT%H:%M:%S.%fZ"),
            "ingest_ts": row[4].strftime("%Y-%m-%dT%H:%M:%S.%fZ"),
            "first_update_id": row[6],
            "last_update_id": row[7],
            "bids": row[8],
            "asks": row[9],
        }
    )


def _put(df, folder, number):
    """One more input file, ordered by name and time."""
    df.coalesce(1).write.mode("append").parquet(f"{folder}/part{number:03d}")


def _stream(spark, folder, schema):
    return stream_files(spark, f"{folder}/part*", schema)


@pytest.mark.parametrize("cuts", [[], [90], [30, 31, 120]])
def test_ticker_stream_equals_batch(spark, folder, cuts):
    """Any split of the input into runs gives the same tickers; state survives the restarts."""
    from pyspark.sql import types as T

    rows = random_diffs(11, n=160)
    bad = ["{", None, '{"exchange":"x"}']
    records = [(_payload(r), 0, r[12], r[5]) for r in rows]
    records += [(p, 0, 1000 + i, at(0)) for i, p in enumerate(bad)]
    schema = T.StructType([*RAW_RECORD.fields, T.StructField("processed_ts", T.TimestampType())])
    sinks = jobs.TickerSinks(f"{folder}/silver", f"{folder}/topic", f"{folder}/dlq")
    edges = [0, *cuts, len(records)]
    for number, (a, b) in enumerate(zip(edges, edges[1:])):
        _put(spark.createDataFrame(records[a:b], schema), f"{folder}/in", number)
        raw = _stream(spark, f"{folder}/in", schema)
        jobs.start_ticker_job(raw, sinks, f"{folder}/state", available_now=True).awaitTermination()
    silver = spark.read.schema(BOOK_TICKER).parquet(f"{folder}/silver")
    expected = sequential_quotes(rows)
    assert quotes_of(silver) == expected
    messages = spark.read.schema("key string, value string, batch string")
    assert messages.json(f"{folder}/topic").count() == len(expected)
    letters = messages.json(f"{folder}/dlq").select(F.get_json_object("value", "$.error_type").alias("e"))
    counts = {r["e"]: r["count"] for r in letters.groupBy("e").count().collect()}
    late = counts.pop("late_event")
    assert counts == {"malformed_json": 1, "tombstone": 1, "missing_field": 1}
    seen, expected_late = {}, 0
    for r in rows:
        if r[2] not in seen or r[7] > seen[r[2]]:
            seen[r[2]] = r[7]
            expected_late += (r[5] - r[3]).total_seconds() > 30
    assert late == expected_late > 0


def test_idle_state_can_expire(spark, folder):
    """The expiring form of the state runs and gives the same tickers while nothing is idle."""
    from pyspark.sql import types as T

    rows = random_diffs(3, n=40, late=False)
    schema = T.StructType([*RAW_RECORD.fields, T.StructField("processed_ts", T.TimestampType())])
    _put(spark.createDataFrame([(_payload(r), 0, r[12], r[5]) for r in rows], schema), f"{folder}/in", 0)
    raw, sinks = _stream(spark, f"{folder}/in", schema), jobs.TickerSinks(f"{folder}/silver")
    query = jobs.start_ticker_job(raw, sinks, f"{folder}/state", ttl_ms=jobs.STATE_TTL_MS, interval="1 second")
    for _ in range(60):
        if query.awaitTermination(1) or os.path.exists(f"{folder}/state/commits/0"):
            break
    query.stop()
    with pytest.raises(ValueError):
        jobs.start_ticker_job(raw, sinks, f"{folder}/other", ttl_ms=1000, available_now=True)
    assert quotes_of(spark.read.schema(BOOK_TICKER).parquet(f"{folder}/silver")) == sequential_quotes(rows)


def test_bars_from_the_ticker_topic(spark, folder):
    """Ticker messages in, bars out: the topic form of the second job."""
    from tidebook.sources.wire import ticker_stream

    rows = [tick("a", 7 * i, 100.0 + i % 9, float(i % 3), u=i) for i in range(30)]
    messages = topics.to_messages(ticks(spark, rows)).select(F.col("value").alias("payload"))
    bad = spark.createDataFrame([("{",), (None,), ("[]",)], "payload string")
    _put(messages.unionByName(bad), f"{folder}/in", 0)
    source = ticker_stream(_stream(spark, f"{folder}/in", "payload string"))
    query = ohlcv(source).writeStream.format("memory").queryName("topic_bars").trigger(availableNow=True).start()
    query.awaitTermination()
    closed = ohlcv(ticks(spark, rows)).where(F.col("window_end") <= F.lit(at(7 * 29 - 5)))
    assert _rows(spark.table("topic_bars")) == _rows(closed)


def test_processor_state_round_trip():
    class State:
        value = None

        def exists(self):
            return self.value is not None

        def get(self):
            return self.value

        def update(self, value):
            self.value = value

    processor = BookProcessor()
    processor.state = State()
    last, book = processor._load()
    assert last is None
    book.apply(["100.0", "100.00", "99"], [1.0, 2.0, 3.0], [], [])
    book.apply(["100.0", "100.0"], [0.0, 4.0], [], [])
    processor._save(7, book)
    last, again = processor._load()
    assert last == 7 and again.bids.by_age() == book.bids.by_age() and again.asks.by_age() == []


def test_bars_stream_emits_closed_windows_once(spark, folder):
    rows = [tick("a", 7 * i, 100.0 + i % 9, float(i % 3), u=i) for i in range(60)]
    path = f"{folder}/bars"
    for number, part in enumerate((rows[:20], rows[20:41], rows[41:])):
        _put(ticks(spark, part), f"{folder}/in", number)
        source = _stream(spark, f"{folder}/in", BOOK_TICKER)
        jobs.start_bars_job(source, path, f"{folder}/state", available_now=True).awaitTermination()
    closed = ohlcv(ticks(spark, rows)).where(F.col("window_end") <= F.lit(at(7 * 59 - 5)))
    got = spark.read.parquet(path).drop("event_date")
    assert _rows(got) == _rows(closed) and got.count() == 6
    # a row later than a whole closed window is dropped
    _put(ticks(spark, [tick("a", 1, 999.0, u=500), tick("zz", 4000, 1.0, u=501)]), f"{folder}/in", 9)
    jobs.start_bars_job(_stream(spark, f"{folder}/in", BOOK_TICKER), path, f"{folder}/state", available_now=True).awaitTermination()
    after = spark.read.parquet(path).drop("event_date")
    assert _rows(after) == _rows(ohlcv(ticks(spark, rows)))
    # a backfill shares the table
    run_backfill(ticks(spark, rows), path, date(2024, 1, 1), date(2024, 1, 2))
    assert _rows(spark.read.parquet(path).drop("event_date")) == _rows(ohlcv(ticks(spark, rows)))


def test_changes_stream_equals_batch(spark, folder):
    payloads = [
        _envelope("r", after=_image("A"), lsn=1),
        _envelope("c", after=_image("B"), lsn=2),
        "{",
        _envelope("u", before=_image("A"), after=_image("A", "BREAK"), lsn=3),
        _envelope("d", before=_image("B"), lsn=4),
        _envelope("x", after=_image("C"), lsn=5),
        _envelope("c", after=_image("C"), lsn=6),
    ]
    raw = _raw(spark, payloads)
    for number, keep in enumerate(("kafka_offset < 3", "kafka_offset >= 3")):
        _put(raw.where(keep), f"{folder}/in", number)
        source = _stream(spark, f"{folder}/in", RAW_RECORD)
        jobs.start_changes_job(
            source, f"{folder}/audit", f"{folder}/config", f"{folder}/state",
            ingest_ts=at(0), dead_letter_path=f"{folder}/dlq", available_now=True,
        ).awaitTermination()
    audit = audit_rows(flatten_envelopes(raw, at(0)))
    assert _rows(spark.read.schema(audit.schema).parquet(f"{folder}/audit")) == _rows(audit)
    assert _rows(tables.read_state(spark, f"{folder}/config")) == _rows(current_state(audit))
    assert spark.read.schema("key string, value string").json(f"{folder}/dlq").count() == 2


def test_shared_folder_comes_from_the_session(spark):
    from tidebook.session import shared_dir

    root = spark.conf.get("spark.checkpoint.dir")
    assert shared_dir(spark, "x").startswith(root)
    assert shared_dir(spark, "x") != shared_dir(spark, "x")


def test_batch_job_from_payloads(spark):
    """Parsing and folding compose: payload text in, tickers out."""
    from tidebook.operators.orderbook import book_ticker
    from tidebook.sources.wire import accepted, parse_diff_events

    rows = [diff(u, [(str(100 - u % 3), "1")], [(str(101 + u % 3), "2")]) for u in range(1, 20)]
    raw = _raw(spark, [_payload(r) for r in rows]).withColumn("processed_ts", F.lit(at(20)))
    direct = diffs(spark, rows)
    assert set(quotes_of(book_ticker(accepted(parse_diff_events(raw))))) == set(quotes_of(book_ticker(direct)))
