"""Book state, sequence rules and the batch fold."""

from __future__ import annotations

import random

import pytest
from helpers import diff, diffs, quote_of, quotes_of, random_diffs, sequential_quotes, snapshots

from pyspark.sql import functions as F

from tidebook.operators.book import Book
from tidebook.operators.orderbook import book_from_snapshots, book_ticker, image_metrics, levels_at_start
from tidebook.operators.sequence import classify_sequence, deduped_blocks, gap_report, monotone_dedup, tag_late


def test_levels_are_set_overwritten_and_deleted():
    book = Book()
    book.apply(["100", "99"], [1.0, 2.0], ["101"], [3.0])
    assert book.quote(5) == (100.0, 1.0, 101.0, 3.0, 3.0, 3.0)
    book.apply(["100"], [0.0], ["101"], [4.0])
    assert book.quote(5) == (99.0, 2.0, 101.0, 4.0, 2.0, 4.0)
    book.apply(["98"], [0.0], [], [])  # deleting an absent level
    assert len(book.bids.live) == 1


def test_one_sided_book_has_no_quote():
    book = Book()
    book.apply(["100"], [1.0], [], [])
    assert book.quote(5) is None


def test_only_the_best_levels_count():
    book = Book()
    book.apply([str(100 - i) for i in range(8)], [1.0] * 8, [str(101 + i) for i in range(8)], [2.0] * 8)
    assert book.quote(5)[4:] == (5.0, 10.0)


def test_equal_prices_rank_by_age():
    book = Book()
    book.apply(["100.0", "100.00"], [1.0, 2.0], ["101"], [1.0])
    assert book.quote(5)[1] == 1.0
    book.apply(["100.0"], [5.0], [], [])  # overwriting keeps the age
    assert book.quote(5)[1] == 5.0
    book.apply(["100.0", "100.0"], [0.0, 9.0], [], [])  # re-adding makes it the youngest
    assert book.quote(5)[1] == 2.0
    assert book.bids.by_age() == [("100.00", 2.0), ("100.0", 9.0)]


@pytest.mark.parametrize("span", [7, 40, 100_000])
@pytest.mark.parametrize("seed", [1, 2])
def test_fold_equals_sequential_reader(spark, seed, span):
    rows = random_diffs(seed)
    for fold_rows in (5, 60, 65_536):
        assert quotes_of(book_ticker(diffs(spark, rows), span=span, fold_rows=fold_rows)) == sequential_quotes(rows)


def test_blocks_do_not_lose_old_levels(spark):
    """A level set once stays through many blocks without a change, for a busy and a quiet instrument."""
    rows = [diff(1, [("100", "1")], [("105", "2")], offset=0), diff(1, [("9", "1")], [("10", "1")], offset=1, symbol="q")]
    rows += [diff(u, [("90", str(u))], [], offset=u) for u in range(2, 200)]
    rows += [diff(2, [("8", "4")], [], offset=400, symbol="q")]
    assert quotes_of(book_ticker(diffs(spark, rows), span=3, fold_rows=4)) == sequential_quotes(rows)


def test_delivering_everything_twice_changes_nothing(spark):
    rows = random_diffs(5, late=False)
    again = [(*r[:12], r[12] + 10_000) for r in rows]
    once = quotes_of(book_ticker(diffs(spark, rows), span=50))
    assert quotes_of(book_ticker(diffs(spark, rows + again), span=50)) == once


def test_ticker_columns(spark):
    rows = [diff(1, [("100", "3")], [("102", "1")], first=0)]
    row = book_ticker(diffs(spark, rows)).first()
    assert (row["spread"], row["mid_price"], row["imbalance"]) == (2.0, 101.0, 0.75)
    assert (row["event_id"], row["first_update_id"], row["kafka_offset"]) == ("x#btc#1", 0, 1)


def test_late_diff_uses_its_id_but_not_the_book(spark):
    rows = [
        diff(1, [("100", "1")], [("101", "1")], offset=0),
        diff(5, [("100.5", "9")], [], offset=1, lag=30.001),
        diff(4, [("100.4", "9")], [], offset=2),
        diff(6, [("99", "1")], [], offset=3, lag=30),
    ]
    got = quotes_of(book_ticker(diffs(spark, rows)))
    assert set(got) == {("btc", 1), ("btc", 6)}
    assert got[("btc", 6)][0] == 100.0
    tagged = {r["last_update_id"]: r["error_type"] for r in tag_late(diffs(spark, rows)).collect()}
    assert tagged == {1: None, 5: "late_event", 4: None, 6: None}


@pytest.mark.parametrize("span", [3, 1000])
def test_dedup_keeps_rising_ids(spark, span):
    ids = [3, 5, 5, 4, 9, 9, 8, 10, 1, 11]
    rows = [diff(u, offset=i) for i, u in enumerate(ids)]
    rows += [diff(u, offset=100 + i, symbol="eth") for i, u in enumerate([1, 1, 2])]
    kept = monotone_dedup(diffs(spark, rows), span).collect()
    assert sorted(r["kafka_offset"] for r in kept) == [0, 1, 4, 7, 9, 100, 102]


@pytest.mark.parametrize("span", [2, 1000])
def test_stale_gap_and_contiguous(spark, span):
    rows = [
        diff(100, first=90, offset=0),
        diff(99, first=99, offset=1),  # stale
        diff(102, first=101, offset=2),  # contiguous
        diff(105, first=104, offset=3),  # 103 is missing
        diff(105, first=104, offset=4),  # repeated
        diff(110, first=103, offset=5),  # overlaps, no gap
        diff(120, first=115, offset=6),  # 111..114 are missing
    ]
    got = {r["kafka_offset"]: r for r in classify_sequence(diffs(spark, rows), span).collect()}
    assert [o for o in got if got[o]["is_stale"]] == [1, 4] or {o for o in got if got[o]["is_stale"]} == {1, 4}
    assert {o for o in got if got[o]["is_gap"]} == {3, 6}
    assert [got[o]["segment_id"] for o in range(7)] == [0, 0, 0, 1, 1, 1, 2]
    gaps = {r["kafka_offset"]: (r["expected_update_id"], r["missing_ids"]) for r in gap_report(diffs(spark, rows), span).collect()}
    assert gaps == {3: (103, 1), 6: (111, 4)}


def _protocol(snaps, rows):
    """Sequential snapshot protocol in id order, per instrument."""
    out = {}
    steps = [(s[0], s[1], 1, s) for s in snaps] + [(r[2], r[7], 0, r) for r in rows]
    state = {}
    for symbol, u, is_snapshot, item in sorted(steps, key=lambda x: (x[0], x[1], x[2])):
        book, last, valid, origin = state.get(symbol, (None, None, False, None))
        if is_snapshot:
            book = tuple({p: float(q) for p, q in side} for side in item[2:4])
            state[symbol] = (book, u, True, u)
            continue
        if not valid or u <= last:
            continue
        if item[6] > last + 1:
            state[symbol] = (book, last, False, origin)
            continue
        for side, updates in zip(book, item[8:10]):
            for price, qty in updates:
                side.pop(price, None) if float(qty) == 0 else side.__setitem__(price, float(qty))
        state[symbol] = (book, u, True, origin)
        quote = quote_of(book)
        if quote:
            out[(symbol, u)] = (quote, origin)
    return out


@pytest.mark.parametrize("span", [4, 1000])
def test_snapshot_protocol(spark, span):
    image = ([("100", "1"), ("99", "2")], [("101", "3"), ("102", "1")])
    snaps = [("btc", 10, *image), ("btc", 30, [("50", "1")], [("51", "1")]), ("eth", 4, *image)]
    rows = [
        diff(9, [("100.5", "1")], [], first=9),  # below the snapshot
        diff(12, [("100", "0")], [("101", "0")], first=11),
        diff(14, [("98", "1")], [], first=13),
        diff(20, [("97", "1")], [], first=18),  # gap
        diff(22, [("96", "1")], [], first=21),  # waits for a snapshot
        diff(31, [("49", "2")], [], first=29),  # overlaps the new snapshot
        diff(33, [("48", "2")], [], first=32),
        diff(3, [("1", "1")], [], first=3, symbol="sol"),  # never had a snapshot
        diff(6, [("100", "5")], [], first=5, symbol="eth"),
    ]
    got = book_from_snapshots(snapshots(spark, snaps), diffs(spark, rows), span=span)
    origins = {(r["symbol"], r["last_update_id"]): r["snapshot_id"] for r in got.collect()}
    expected = _protocol(snaps, rows)
    assert quotes_of(got) == {k: v[0] for k, v in expected.items()}
    assert origins == {k: v[1] for k, v in expected.items()}
    assert set(expected) == {("btc", 12), ("btc", 14), ("btc", 31), ("btc", 33), ("eth", 6)}


def test_image_metrics(spark):
    bids = [(str(100 - i), "1") for i in range(7)]
    asks = [("101", "2"), ("103", "4"), ("102", "0")]
    row = image_metrics(snapshots(spark, [("btc", 1, bids, asks), ("eth", 1, [], [])])).where("symbol = 'btc'").first()
    assert (row["best_bid_price"], row["best_ask_price"], row["bid_volume"], row["ask_volume"]) == (100.0, 101.0, 5.0, 6.0)
    empty = image_metrics(snapshots(spark, [("eth", 1, [], [])])).first()
    assert (empty["best_bid_price"], empty["imbalance"]) == (None, 0.5)


@pytest.mark.parametrize("fold_rows", [40, 65_536])
def test_carried_levels_never_exceed_updates(spark, fold_rows):
    """Quiet instruments over many blocks: folds follow row counts, so books are not handed from block to block."""
    rnd, rows = random.Random(3), []
    for offset in range(3000):
        symbol = "busy" if offset % 2 else f"quiet{offset % 60}"
        bids, asks = [(f"{100 - rnd.randrange(8)}", "1")], [(f"{101 + rnd.randrange(8)}", rnd.choice(["0", "2"]))]
        rows.append(diff(offset + 1, bids, asks, offset=offset, symbol=symbol))
    df = diffs(spark, rows)
    kept = deduped_blocks(df, 16, fold_rows).withColumn("_pos", F.col("_step") * 16 + F.col("kafka_offset") % 16)
    sizes = [r["count"] for r in kept.groupBy("symbol", "_ord").count().collect()]
    assert max(sizes) <= fold_rows + 16
    carried, updates = levels_at_start(kept, ["exchange", "symbol"]).count(), 2 * len(rows)
    assert carried <= updates / 2 and (carried == 0) == (fold_rows > len(rows))
    assert quotes_of(book_ticker(df, span=16, fold_rows=fold_rows)) == sequential_quotes(rows)
