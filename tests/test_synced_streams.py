"""Snapshot start and gaps in the stream, changelogs from state, mergeable bars."""

from __future__ import annotations

import json
import random

import pytest
from helpers import at, diff, diffs, quotes_of, snapshots, tick, ticks
from pyspark.sql import functions as F

from tidebook.operators import bars
from tidebook.operators.book import Side
from tidebook.operators.orderbook import book_from_snapshots
from tidebook.operators.sequence import gap_report
from tidebook.schemas import DEPTH_SNAPSHOT, DIFF, RAW_RECORD
from tidebook.sources.topics import stream_files
from tidebook.streaming import jobs
from tidebook.streaming.changelog import normalized
from tidebook.streaming.synced import BROKEN, LIVE, WAITING, Sync, write_levels


def _rows(df):
    return sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=repr)


def _put(df, folder, number):
    df.coalesce(1).write.mode("append").parquet(f"{folder}/part{number:03d}")


def _sequence():
    """Two instruments of rising ids with a gap each and rows delivered twice, and a third without a snapshot."""
    rnd, rows, offset = random.Random(2), [], 0
    for u in range(1, 61):
        for symbol, gap in (("btc", 30), ("eth", 22)):
            offset += 1
            if u == gap:
                continue  # the id is missed
            bids = [(f"{100 - rnd.randrange(6)}", rnd.choice(["0", "1", "2.5"])) for _ in range(2)]
            asks = [(f"{101 + rnd.randrange(6)}", rnd.choice(["0", "3", "1.5"])) for _ in range(2)]
            rows.append(diff(u, bids, asks, symbol=symbol, offset=offset))
            if u % 9 == 0:
                rows.append(diff(u, bids, asks, symbol=symbol, offset=offset + 10_000))
    rows.append(diff(5, [("1", "1")], [], symbol="sol", offset=999))
    return rows


_IMAGE = [("100", "5"), ("99", "4")], [("101", "6"), ("102", "7")]
_STARTS = [("btc", 10, *_IMAGE), ("eth", 3, *_IMAGE), ("btc", 40, *_IMAGE), ("eth", 35, *_IMAGE)]


# Batches of (last diff id, snapshots that arrive with them): before, between and after their diffs.
@pytest.mark.parametrize(
    "batches",
    [
        [(99, [0, 1, 2, 3])],
        [(0, [0, 1]), (38, []), (39, [2, 3]), (99, [])],
        [(20, []), (25, [0, 1]), (29, []), (37, []), (50, [2, 3]), (99, [])],
        [(28, []), (29, [1, 0]), (60, []), (99, [3, 2])],
    ],
)
def test_stream_from_snapshots_equals_batch(spark, folder, batches):
    rows, low = _sequence(), -1
    for number, (high, images) in enumerate(batches):
        # Second deliveries come with the diffs of their own id.
        part = [r for r in rows if low < r[7] <= high]
        low = high
        _put(diffs(spark, part), f"{folder}/diffs", number)
        _put(snapshots(spark, [_STARTS[i] for i in images]), f"{folder}/images", number)
        job = jobs.start_synced_job(
            stream_files(spark, f"{folder}/diffs/part*", DIFF),
            stream_files(spark, f"{folder}/images/part*", DEPTH_SNAPSHOT),
            f"{folder}/silver",
            f"{folder}/gaps",
            f"{folder}/state",
            available_now=True,
        )
        job.awaitTermination()
    got = spark.read.parquet(f"{folder}/silver").drop("event_date")
    want = book_from_snapshots(snapshots(spark, _STARTS), diffs(spark, rows))
    assert quotes_of(got) == quotes_of(want) and got.count() > 60
    ids = ["symbol", "last_update_id", "snapshot_id"]
    assert _rows(got.select(*ids)) == _rows(want.select(*ids))
    missed = spark.read.parquet(f"{folder}/gaps")
    assert _rows(missed.drop("status")) == _rows(gap_report(diffs(spark, rows)))
    assert {r.status for r in missed.collect()} <= {WAITING, BROKEN}


def _held(u, first=None, before=None):
    return (f"e{u}", "x", "s", 0, 0, 0, u if first is None else first, u, "raw", 0, u, ["100"], [1.0], ["101"], [2.0], before)


def test_states_of_one_instrument():
    sync = Sync(depth=5)
    assert sync.diff(_held(7, before=6)) is None and sync.diff(_held(8, before=7)) is None
    assert (sync.status, len(sync.held)) == (WAITING, 2)
    replayed = list(sync.snapshot(7, [["99"], [1.0], ["102"], [1.0]]))
    assert [row[7] for row, _ in replayed] == [8] and (sync.status, sync.held) == (LIVE, [])
    assert sync.diff(_held(9, before=8)) is not None
    assert sync.diff(_held(12, before=9)) is None and (sync.status, len(sync.held)) == (BROKEN, 1)
    # A snapshot that does not reach the gap leaves it broken, with the diff still held.
    assert list(sync.snapshot(9, [["99"], [1.0], [], []])) == [] and (sync.status, len(sync.held)) == (BROKEN, 1)
    assert [row[7] for row, _ in sync.snapshot(11, [["99"], [1.0], [], []])] == [12]
    assert list(sync.snapshot(5, [["1"], [1.0], [], []])) == [] and sync.snapshot_id == 11  # behind a live book
    assert list(sync.snapshot(20, [["1"], [1.0], ["2"], [1.0]])) == [] and sync.snapshot_id == 20


class _Levels(dict):
    writes = 0

    def updateValue(self, key, value):
        self.writes += 1
        self[key] = value

    def removeKey(self, key):
        self.writes += 1
        del self[key]


def test_only_changed_levels_are_written():
    side, state = Side(-1.0), _Levels()
    for price in range(1000):
        side.put(str(price), 1.0)
    assert write_levels(state, side, {}) == 1000
    before = {price: value for (price,), value in state.items()}
    side.put("5", 0.0)
    side.put("7", 3.0)
    side.put("2000", 1.0)
    side.put("9", 1.0)  # the quantity it has
    state.writes = 0
    assert write_levels(state, side, before) == state.writes == 3
    assert {p: v[0] for (p,), v in state.items()} == {p: level[2] for p, level in side.live.items()}


def test_changelog_rules():
    assert normalized(None, "u", "a") == ("a", [("INSERT", "a")])
    assert normalized("a", "c", "b") == ("b", [("UPDATE_BEFORE", "a"), ("UPDATE_AFTER", "b")])
    assert normalized("a", "r", "a") == ("a", []) and normalized("a", "u", None) == ("a", [])
    assert normalized("a", "d", None) == (None, [("DELETE", "a")]) and normalized(None, "d", None) == (None, [])


def _change(op, symbol, lsn, value=None, old=None):
    image = lambda v: None if v is None else {"symbol": symbol, "status": v}
    body = {"op": op, "before": image(old), "after": image(value), "source": {"lsn": lsn, "ts_ms": 1, "txId": 1}, "ts_ms": 2}
    return (json.dumps(body), 0, lsn)


def test_changelog_over_restarts_and_repeats(spark, folder):
    events = [
        _change("c", "A", 1, "new"), _change("u", "A", 2, "on"), _change("u", "B", 3, "first"), _change("u", "A", 2, "on"),
        _change("d", "A", 5, old="key"), _change("d", "A", 6, old="key"), _change("c", "A", 7, "again"), _change("u", "A", 4, "late"),
    ]
    schema = [f.name for f in RAW_RECORD.fields]
    for number, (a, b) in enumerate([(0, 2), (2, 4), (4, 7), (7, 8)]):
        part = spark.createDataFrame([(p, k, o) for p, k, o in events[a:b]], "payload string, kafka_partition int, kafka_offset long")
        _put(part.select(*[c for c in schema if c in part.columns]), f"{folder}/in", number)
        raw = stream_files(spark, f"{folder}/in/part*", part.schema)
        jobs.start_changelog_job(raw, f"{folder}/out", f"{folder}/state", available_now=True).awaitTermination()
    rows = spark.read.parquet(f"{folder}/out").select("symbol", "source_lsn", "row_kind", F.get_json_object("image_json", "$.status"))
    assert sorted(tuple(r) for r in rows.collect()) == [
        ("A", 1, "INSERT", "new"),
        ("A", 2, "UPDATE_AFTER", "on"),
        ("A", 2, "UPDATE_BEFORE", "new"),
        ("A", 5, "DELETE", "on"),
        ("A", 7, "INSERT", "again"),
        ("B", 3, "INSERT", "first"),
    ]


@pytest.mark.parametrize("mode", bars.VWAP_MODES)
def test_partial_bars_merge_in_any_order(spark, mode):
    rnd = random.Random(7)
    rows = [tick(s, rnd.randrange(300), 100 + rnd.randrange(50) / 4, qty=rnd.choice([0.0, 1.0, 2.5]), u=u) for u, s in enumerate("ab" * 80)]
    df = ticks(spark, rows).withColumn("part", F.pmod(F.hash("last_update_id"), F.lit(5)))
    parts = bars.partial_bars(df, by=("part",))
    straight = bars.merge_partials(parts)
    nested = parts.where("part < 2")
    for part in (4, 2, 3):
        nested = bars.merge_partials(nested.select(*straight.columns).unionByName(parts.where(f"part = {part}").select(*straight.columns)))
    want = _rounded(bars.ohlcv(df, vwap_mode=mode))
    assert _rounded(bars.finish_bars(straight, mode)) == want == _rounded(bars.finish_bars(nested, mode))
    assert bars.finish_bars(bars.merge_partials(parts.limit(0))).count() == 0


def _rounded(df):
    return _rows(df.withColumns({c: F.round(c, 9) for c in ("volume", "vwap")}))


def test_partial_bars_include_late_ticks(spark, folder):
    """What a watermark would drop is in the merged bars."""
    rows = [tick("a", s, 100.0 + s, u=s) for s in (0, 10, 500, 900)]
    late = [tick("a", 5, 50.0, u=5)]
    for number, part in enumerate([rows, late]):
        df = ticks(spark, part)
        _put(df, f"{folder}/in", number)
        stream = stream_files(spark, f"{folder}/in/part*", df.schema)
        jobs.start_partial_bars_job(stream, f"{folder}/out", f"{folder}/state", available_now=True).awaitTermination()
    merged = bars.finish_bars(bars.merge_partials(spark.read.parquet(f"{folder}/out")))
    assert _rounded(merged) == _rounded(bars.ohlcv(ticks(spark, rows + late)))
    assert merged.where(F.col("window_start") == F.lit(at(0))).first().low_price == 50.0
