"""Parsing, change envelopes, replay and quality."""

from __future__ import annotations

import json
from datetime import timedelta

import pytest
from helpers import at, diff, diffs, tick, ticks
from pyspark.sql import functions as F

from tidebook.operators import changes, quality
from tidebook.operators.orderbook import book_ticker
from tidebook.plans import replay, serving
from tidebook.sources import tables, topics, wire


def _raw(spark, payloads):
    rows = [(p, 0, i) for i, p in enumerate(payloads)]
    return spark.createDataFrame(rows, "payload string, kafka_partition int, kafka_offset long")


def _by_offset(df, column):
    return {r["kafka_offset"]: r[column] for r in df.collect()}


def _event(**over):
    event = {
        "event_id": "x#btc#7",
        "exchange": "x",
        "symbol": "btc",
        "exchange_event_ts": "2024-01-01T00:00:01.500Z",
        "ingest_ts": "2024-01-01T00:00:02Z",
        "first_update_id": 5,
        "last_update_id": 7,
        "bids": [["100.0", "1"]],
        "asks": [["101.0", "2"]],
    }
    event.update(over)
    return json.dumps({k: v for k, v in event.items() if v != "absent"})


def test_diff_events(spark):
    payloads = [
        _event(),
        _event(exchange_event_ts="", event_time=1704067201500, ingest_ts="absent", ingest_time="2024-01-01T00:00:03Z"),
        _event(first_update_id="absent", bids=None, ingest_ts="absent"),
        "{not json",
        None,
        _event(symbol="absent"),
        _event(last_update_id="seven"),
        _event(bids=[["100.0"]]),
        _event(asks=[["abc", "1"]]),
        _event(exchange_event_ts="yesterday"),
        "[1, 2]",
    ]
    parsed = wire.parse_diff_events(_raw(spark, payloads), at(5))
    assert _by_offset(parsed, "error_type") == {
        0: None,
        1: None,
        2: None,
        3: "malformed_json",
        4: "tombstone",
        5: "missing_field",
        6: "bad_number",
        7: "bad_levels",
        8: "bad_levels",
        9: "bad_timestamp",
        10: parsed.where("kafka_offset = 10").first()["error_type"],
    }
    assert parsed.where("kafka_offset = 10").first()["error_type"] in ("malformed_json", "missing_field")
    good = wire.accepted(parsed).orderBy("kafka_offset")
    times = good.select(F.unix_millis("exchange_event_ts"), F.unix_millis("ingest_ts")).collect()
    assert [tuple(t) for t in times] == [
        (1704067201500, 1704067202000),
        (1704067201500, 1704067203000),
        (1704067201500, 1704067205000),
    ]
    third = good.collect()[2]
    assert (third["first_update_id"], third["bids"], third["asks"]) == (0, [], [["101.0", "2"]])
    letters = wire.dead_letters(parsed)
    assert letters.count() == 8
    assert letters.where("error_type = 'bad_number'").first()["original_key"] == "x#btc"
    assert letters.where("error_type = 'tombstone'").first()["original_payload"] == ""


def test_wire_diffs(spark):
    good = {"e": "depthUpdate", "E": 1704067200123, "s": "BTCUSDT", "U": 157, "u": 160, "b": [["50000.00", "1.000"]], "a": []}
    payloads = [
        json.dumps(good),
        json.dumps({**good, "e": "trade"}),
        json.dumps({k: v for k, v in good.items() if k != "u"}),
        json.dumps({**good, "b": [["1", "2", "3"]]}),
        json.dumps({**good, "U": "x"}),
        "oops",
    ]
    parsed = wire.parse_wire_diffs(_raw(spark, payloads), "x", at(1))
    assert _by_offset(parsed, "error_type") == {
        0: None,
        2: "missing_field",
        3: "bad_levels",
        4: "bad_number",
        5: "malformed_json",
    }
    row = wire.accepted(parsed).first()
    assert (row["event_id"], row["symbol"], row["first_update_id"]) == ("x#btcusdt#160", "btcusdt", 157)
    assert row["bids"] == [["50000.00", "1.000"]]


def test_filters_do_not_repeat_the_json_parse(spark):
    plan = wire.accepted(wire.parse_diff_events(_raw(spark, [_event()])))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_topic_decode_skips_tombstones(spark):
    rows = [(bytearray(b'{"a":1}'), 0, 0), (None, 0, 1), (bytearray("é".encode()), 3, 9)]
    df = spark.createDataFrame(rows, "value binary, kafka_partition int, kafka_offset long")
    assert [tuple(r) for r in topics.decode_records(df).collect()] == [('{"a":1}', 0, 0), ("é", 3, 9)]


def test_offsets_json():
    start, end = topics.offsets_json("t", [(0, 5, 9), (2, 1, None)])
    assert json.loads(start) == {"t": {"0": 5, "2": 1}}
    assert json.loads(end) == {"t": {"0": 9, "2": -1}}


def _envelope(op="u", before=None, after=None, lsn=1, **over):
    body = {"before": before, "after": after, "source": {"lsn": lsn, "ts_ms": 10, "txId": 3}, "op": op, "ts_ms": 20}
    body.update(over)
    return json.dumps(body)


def _image(symbol="BTC", status="TRADING", **over):
    return {
        "symbol": symbol,
        "exchange": "x",
        "status": status,
        "base_asset": symbol,
        "quote_asset": "USDT",
        "lot_size_min": 0.1,
        "lot_size_step": 0.1,
        "tick_size": 0.01,
        "created_at": 1704067200000,
        "updated_at": 1704067200123,
        **over,
    }


def test_envelopes(spark):
    payloads = [
        _envelope("r", after=_image()),
        _envelope("u", before=None, after=_image(status="BREAK"), lsn=5),
        _envelope("d", before=_image("ETH"), lsn=7),
        _envelope("c", after={"status": "TRADING"}, source=None, ts_ms=None),
        _envelope("x", after=_image()),
        _envelope("", after=_image()),
        _envelope("u"),
        "{",
        None,
    ]
    flat = changes.flatten_envelopes(_raw(spark, payloads), at(0))
    assert _by_offset(flat, "error_type") == {
        0: None,
        1: None,
        2: None,
        3: None,
        4: "unknown_op",
        5: "missing_op",
        6: "empty_payload",
        7: "malformed_json",
        8: "tombstone",
    }
    audit = changes.audit_rows(flat).orderBy("kafka_offset").collect()
    assert [r["symbol"] for r in audit] == ["BTC", "BTC", "ETH", "UNKNOWN"]
    assert (audit[1]["source_lsn"], audit[1]["source_ts_ms"], audit[1]["source_tx_id"], audit[1]["debezium_ts_ms"]) == (5, 10, 3, 20)
    assert (audit[3]["source_lsn"], audit[3]["source_ts_ms"], audit[3]["debezium_ts_ms"]) == (0, 0, 0)
    assert audit[0]["before_json"] is None and json.loads(audit[0]["after_json"]) == _image()
    assert audit[2]["after_json"] is None
    assert changes.rejected_envelopes(flat).count() == 5


def test_state_replays_in_log_order(spark):
    payloads = [
        _envelope("c", after=_image("A"), lsn=1),
        _envelope("u", after=_image("A", "HALT"), lsn=9),  # arrives before an older event
        _envelope("u", after=_image("A", "BREAK"), lsn=5),
        _envelope("d", before=_image("B"), lsn=8),
        _envelope("c", after=_image("B"), lsn=2),
        _envelope("d", before=_image("C"), lsn=3),
        _envelope("c", after=_image("C", tick_size=0.5), lsn=4),  # created again
    ]
    audit = changes.audit_rows(changes.flatten_envelopes(_raw(spark, payloads), at(0)))
    state = {r["symbol"]: r for r in changes.current_state(audit).collect()}
    assert set(state) == {"A", "C"}
    assert state["A"]["status"] == "HALT" and state["C"]["tick_size"] == 0.5
    stamp = changes.current_state(audit).select(F.unix_millis("updated_at")).first()[0]
    assert stamp == 1704067200123
    assert [r["source_lsn"] for r in serving.audit_listing(audit, 3).collect()] == [1, 2, 3]


# Replay


def _lineage(spark, pairs):
    rows = [tick("a" if i % 2 else "b", i, 1.0, u=i, partition=p, offset=o) for i, (p, o) in enumerate(pairs)]
    return ticks(spark, rows)


def test_offset_ranges(spark):
    df = _lineage(spark, [(0, 100), (0, 200), (1, 50), (-1, -1), (2, -1)])
    assert [tuple(r) for r in replay.offset_ranges(df).collect()] == [(0, 100, 201), (1, 50, 51)]
    assert replay.offset_ranges(_lineage(spark, [(-1, -1)] * 3)).isEmpty()
    assert replay.offset_ranges(df, at(500), at(600)).isEmpty()
    assert [tuple(r) for r in replay.offset_ranges(df, at(0), at(2)).collect()] == [(0, 100, 201)]  # end is exclusive
    assert [tuple(r) for r in replay.offset_ranges(df, symbol="A").collect()] == [(0, 200, 201)]


def _records(spark, n=40, partitions=3):
    rows = [(f"x#{'ab'[i % 2]}", f"v{i}", i % partitions, i // partitions, at(i)) for i in range(n)]
    return spark.createDataFrame(rows, "key string, value string, kafka_partition int, kafka_offset long, record_ts timestamp")


def test_time_ranges(spark):
    records = _records(spark, 12)
    got = [tuple(r) for r in replay.time_offset_ranges(records, at(4), at(8)).collect()]
    assert got == [(0, 2, 3), (1, 1, 3), (2, 1, 2)]
    open_end = replay.time_offset_ranges(records, at(9), at(99)).collect()
    assert {r["end_offset"] for r in open_end} == {replay.OPEN_END}
    assert replay.time_offset_ranges(records, at(50), at(99)).isEmpty()
    assert replay.time_offset_ranges(records, at(4.5), at(4.6)).isEmpty()


def test_range_reads(spark):
    ranges = spark.createDataFrame([(0, 2, 5), (2, 0, 1)], "kafka_partition int, start_offset long, end_offset long")
    got = replay.read_ranges(_records(spark), ranges)
    assert sorted((r["kafka_partition"], r["kafka_offset"]) for r in got.collect()) == [(0, 2), (0, 3), (0, 4), (2, 0)]
    only = replay.read_ranges(_records(spark), ranges, "A").collect()
    assert {r["key"] for r in only} == {"x#a"}


@pytest.mark.parametrize("n", [0, 1, 9, 20, 39, 40, 99])
def test_cap_by_blocks_equals_top_n(spark, n):
    records = _records(spark)
    top = records.orderBy("kafka_partition", "kafka_offset").limit(n).collect()
    assert sorted(replay.first_events(records, n, span=4).collect()) == sorted(top)


def test_replay_runs_and_counts(spark):
    records = _records(spark)
    ticks_df = _lineage(spark, [(p, o) for o in range(3) for p in range(3)])
    published = []
    request = replay.ReplayRequest(at(0), at(9), max_events=5)
    stats = replay.run_replay(ticks_df, records, request, lambda df: published.extend(df.collect())).first()
    assert (stats["events_read"], stats["events_produced"], stats["offset_source"]) == (5, 5, "silver")
    assert stats["partitions_replayed"] == [0, 1, 2] and len(published) == 5
    dry = replay.run_replay(ticks_df, records, replay.ReplayRequest(at(0), at(9), dry_run=True), None).first()
    assert (dry["events_read"], dry["events_produced"]) == (9, 0)
    lost = _lineage(spark, [(-1, -1)])
    fallback = replay.run_replay(lost, records, replay.ReplayRequest(at(3), at(9), dry_run=True), None).first()
    assert (fallback["events_read"], fallback["offset_source"]) == (6, "topic_time")
    with pytest.raises(ValueError):
        replay.run_replay(lost, records, replay.ReplayRequest(at(9), at(9)), None)
    nothing = replay.run_replay(ticks_df, records, replay.ReplayRequest(dry_run=True), None).first()
    assert nothing["events_read"] == 0 and nothing["end_ts"] - nothing["start_ts"] == timedelta(hours=1)


def test_open_ranges_become_latest(spark):
    ranges = replay.time_offset_ranges(_records(spark, 12), at(9), at(99)).collect()
    _, end = topics.offsets_json("t", [(r["kafka_partition"], r["start_offset"], r["end_offset"]) for r in ranges])
    assert set(json.loads(end)["t"].values()) == {-1}


def test_replay_default_window(spark):
    start, end = replay.default_window(as_of=at(7200))
    got = spark.range(1).select(F.unix_seconds(start), F.unix_seconds(end)).first()
    assert got[1] - got[0] == 3600 and got[1] == int(at(7200).timestamp())


def test_replay_leaves_tickers_unchanged(spark):
    rows = [diff(u, [(str(90 + u % 7), str(u % 3))], [(str(101 + u % 5), "1")], offset=u) for u in range(1, 60)]
    replayed = rows + [(*r[:12], r[12] + 1000) for r in rows[10:40]]
    assert sorted(book_ticker(diffs(spark, rows)).collect()) == sorted(book_ticker(diffs(spark, replayed)).collect())


# Quality


def test_rules(spark):
    df = ticks(spark, [tick("a", 1, 10.0), tick("b", 2, None, u=2), tick("a", 3, -5.0, u=1)])
    rules = [
        quality.Rule("not_null", "mid_price"),
        quality.Rule("between", "mid_price", low=0),
        quality.Rule("accepted_values", "symbol", values=["a"]),
        quality.Rule("unique", "event_id"),
        quality.Rule("row_count", low=1, high=2),
    ]
    got = {r["rule"]: (r["failures"], r["passed"]) for r in quality.check(df, "t", rules).collect()}
    assert got == {
        "not_null": (1, False),
        "between": (1, False),
        "accepted_values": (1, False),
        "unique": (1, False),
        "row_count": (1, False),
    }
    assert quality.failed(quality.check(df, "t", rules)).count() == 5


def test_status_rule_reports_halt(spark):
    payloads = [_envelope("c", after=_image("A", "HALT"), lsn=1), _envelope("c", after=_image("B"), lsn=2)]
    state = changes.current_state(changes.audit_rows(changes.flatten_envelopes(_raw(spark, payloads), at(0))))
    rules = quality.model_rules("stg_symbol_config")
    bad = quality.failed(quality.check(state, "stg_symbol_config", rules)).collect()
    assert [(r["rule"], r["column_name"], r["failures"]) for r in bad] == [("accepted_values", "status", 1)]
    allowed = quality.model_rules("stg_symbol_config", [*quality.STATUSES, "HALT"])
    assert quality.failed(quality.check(state, "stg_symbol_config", allowed)).isEmpty()


def test_recent_window(spark):
    df = ticks(spark, [tick("a", 1, 10.0), tick("a", 900, -1.0, u=2)])
    recent = {r["rule"] + r["column_name"]: r["failures"] for r in quality.check_recent(df, "t", "exchange_event_ts", at(1000)).collect()}
    assert recent["betweenbest_bid_price"] == 1 and recent["no_recent_data"] == 0
    empty = quality.failed(quality.check_recent(df, "t", "exchange_event_ts", at(9000))).collect()
    assert [r["rule"] for r in empty] == ["no_recent_data"]
    assert tables.recent(df, 1000, at(1000), limit=1).count() == 1


@pytest.mark.parametrize("age,status", [(120, "pass"), (121, "warn"), (300, "warn"), (301, "error")])
def test_source_freshness(spark, age, status):
    df = ticks(spark, [tick("a", 1000 - age, 10.0)])
    assert quality.source_freshness({"t": (df, "ingest_ts")}, at(1000)).first()["status"] == status
    assert quality.source_freshness({"t": (df.limit(0), "ingest_ts")}, at(1000)).first()["status"] == "error"


def test_registered_tables(spark, folder):
    ticks(spark, [tick("a", 1, 10.0)]).write.parquet(f"{folder}/ticks")
    tables.register_tables(spark, {"book_ticker": f"{folder}/ticks"})
    assert spark.sql("SELECT symbol FROM book_ticker WHERE mid_price > 5").first()[0] == "a"
