from __future__ import annotations

import random

import pandas as pd
import pytest
from helpers import at, diff, diffs, quotes_of, random_diffs, sequential_quotes, snapshots
from pyspark.sql import functions as F
from pyspark.sql import types as T
from test_writes_streams import _payload, _put, _stream

from tidebook.operators.orderbook import book_from_snapshots
from tidebook.schemas import BOOK_TICKER, DEPTH_SNAPSHOT, DIFF, RAW_RECORD
from tidebook.streaming import jobs, synced, ticker


class _Value:
    """A value state without Spark."""

    value = None

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value


def _piece(offsets):
    rows = [
        {c: None for c in ticker._CARRIED}
        | {"last_update_id": o, "kafka_partition": 0, "kafka_offset": o, "bid_px": ["1"], "bid_qty": [1.0], "ask_px": ["2"], "ask_qty": [1.0 + o]}
        for o in offsets
    ]
    return pd.DataFrame(rows)


def _book():
    processor = ticker.BookProcessor()
    processor.state = _Value()
    return processor


def test_ticker_holds_one_piece_of_a_micro_batch():
    taken = []

    def pieces():
        for n in range(3):
            taken.append(n)
            yield _piece(range(10 * n, 10 * n + 10))

    processor = _book()
    out = processor.handleInputRows(("x", "s", -1), pieces(), None)
    first = next(out)
    assert taken == [0] and len(first) == 10  # before: the whole micro-batch was taken first
    assert [len(part) for part in out] == [10, 10] and processor.state.value[0] == 29


def test_pieces_out_of_order_stop_the_fold():
    out = _book().handleInputRows(("x", "s", -1), iter([_piece([5, 6]), _piece([4])]), None)
    with pytest.raises(RuntimeError, match="order of arrival"):
        list(out)


@pytest.fixture
def small_pieces(spark):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, "7")
    yield
    spark.conf.set(key, before)


def test_ticker_stream_in_small_pieces_equals_batch(spark, folder, small_pieces):
    """Records that arrive shuffled, in pieces of seven; the check of streaming plans is on again afterwards."""
    rows = random_diffs(5, n=200)
    records = [(_payload(r), 0, r[12], r[5]) for r in rows]
    records += [("{", 0, 1000 + i, at(0)) for i in range(20)]
    random.Random(1).shuffle(records)
    schema = T.StructType([*RAW_RECORD.fields, T.StructField("processed_ts", T.TimestampType())])
    _put(spark.createDataFrame(records, schema), f"{folder}/in", 0)
    sinks = jobs.TickerSinks(f"{folder}/silver", None, f"{folder}/dlq")
    raw = _stream(spark, f"{folder}/in", schema)
    jobs.start_ticker_job(raw, sinks, f"{folder}/state", available_now=True).awaitTermination()
    assert quotes_of(spark.read.schema(BOOK_TICKER).parquet(f"{folder}/silver")) == sequential_quotes(rows)
    letters = spark.read.schema("key string, value string").json(f"{folder}/dlq")
    assert letters.where(F.get_json_object("value", "$.error_type") != "late_event").count() == 20
    assert spark.conf.get("spark.sql.streaming.unsupportedOperationCheck", "true") == "true"


class _Map(dict):
    def updateValue(self, key, value):
        self[key] = value

    def getValue(self, key):
        return self.get(key)

    def removeKey(self, key):
        del self[key]


def test_held_diffs_wait_in_blocks_of_state(monkeypatch):
    monkeypatch.setattr(synced, "BLOCK_ROWS", 4)
    state = _Map()
    held = synced.Held(state)
    for n in range(10):
        held.append((n,))
    assert len(held) == 2 and len(state) == 2  # before: all rows were in memory
    held.store()
    held = synced.Held(state, held.first, held.end)  # the next micro-batch
    held.append((10,))
    seen = []
    for (n,) in held.drain():
        seen.append(n)
        if n > 5:
            held.append((n,))
    assert seen == list(range(11)) and [n for (n,) in held.drain()] == [6, 7, 8, 9, 10] and not state


def test_synced_stream_in_small_pieces_equals_batch(spark, folder, small_pieces):
    """Diffs that arrive shuffled, pieces of seven, held diffs over several micro-batches."""
    rows = [diff(u, [(f"{100 - u % 3}", "1")], [(f"{101 + u % 3}", "2")], offset=u) for u in range(1, 90) if u not in (30, 61)]
    starts = [("btc", 9, [("99", "1")], [("102", "1")]), ("btc", 45, [("98", "1")], [("103", "1")]), ("btc", 70, [("98", "1")], [("103", "1")])]
    cuts = [(rows[:50], []), (rows[50:], starts)]
    for number, (part, images) in enumerate(cuts):
        random.Random(number).shuffle(part := list(part))
        _put(diffs(spark, part), f"{folder}/diffs", number)
        _put(snapshots(spark, images), f"{folder}/images", number)
        job = jobs.start_synced_job(
            _stream(spark, f"{folder}/diffs", DIFF), _stream(spark, f"{folder}/images", DEPTH_SNAPSHOT),
            f"{folder}/silver", f"{folder}/gaps", f"{folder}/state", available_now=True,
        )
        job.awaitTermination()
    got = spark.read.parquet(f"{folder}/silver").drop("event_date")
    want = book_from_snapshots(snapshots(spark, starts), diffs(spark, rows))
    assert quotes_of(got) == quotes_of(want) and got.count() > 40
    assert spark.read.parquet(f"{folder}/gaps").count() == 2
