"""Small inputs and sequential reference computations."""

from __future__ import annotations

import random
from datetime import datetime, timedelta, timezone

from tidebook.schemas import BOOK_TICKER, DEPTH_SNAPSHOT, DIFF

T0 = datetime(2024, 1, 1, tzinfo=timezone.utc)


def at(seconds: float) -> datetime:
    return T0 + timedelta(seconds=seconds)


def diff(u, bids=(), asks=(), first=None, offset=None, symbol="btc", ts=None, lag=0.0, partition=0, exchange="x"):
    ts = at(u) if ts is None else ts
    return (
        f"{exchange}#{symbol}#{u}",
        exchange,
        symbol,
        ts,
        ts,
        ts + timedelta(seconds=lag),
        u if first is None else first,
        u,
        [list(level) for level in bids],
        [list(level) for level in asks],
        "raw",
        partition,
        u if offset is None else offset,
    )


def diffs(spark, rows):
    return spark.createDataFrame(rows, DIFF)


def snapshots(spark, rows):
    return spark.createDataFrame(
        [("x", s, u, [list(b) for b in bids], [list(a) for a in asks]) for s, u, bids, asks in rows], DEPTH_SNAPSHOT
    )


def tick(symbol, seconds, mid, qty=1.0, u=None, partition=0, offset=None, imbalance=0.5, exchange="x", spread=0.2):
    u = int(seconds) if u is None else u
    offset = u if offset is None else offset
    ts = at(seconds)
    bid = None if mid is None else mid - spread / 2
    ask = None if mid is None else mid + spread / 2
    return (
        f"{exchange}#{symbol}#{u}", exchange, symbol, ts, ts, ts, u, u, bid, qty, ask, 1.0, spread, mid, imbalance,
        "raw", partition, offset,
    )


def ticks(spark, rows):
    return spark.createDataFrame(rows, BOOK_TICKER)


def sequential_quotes(rows, late_seconds=30.0, depth=5, apply_from=None):
    """Brute force over diff tuples in arrival order: {(symbol, u): quote}."""
    books, last, out = {}, {}, {}
    for row in sorted(rows, key=lambda r: (r[11], r[12])):
        symbol, ts, processed, u, bids, asks = row[2], row[3], row[5], row[7], row[8], row[9]
        if symbol in last and u <= last[symbol]:
            continue
        last[symbol] = u
        if late_seconds is not None and (processed - ts).total_seconds() > late_seconds:
            continue
        book = books.setdefault(symbol, ({}, {}))
        for side, updates in zip(book, (bids, asks)):
            for price, qty in updates:
                if float(qty) == 0:
                    side.pop(price, None)
                else:
                    side[price] = float(qty)
        quote = quote_of(book, depth)
        if quote:
            out[(symbol, u)] = quote
    return out


def quote_of(book, depth=5):
    bids, asks = book
    if not bids or not asks:
        return None
    # sorted() is stable, so equal prices stay in insertion order
    best_bids = sorted(bids.items(), key=lambda kv: -float(kv[0]))
    best_asks = sorted(asks.items(), key=lambda kv: float(kv[0]))
    bid_volume = sum(q for _, q in best_bids[:depth])
    ask_volume = sum(q for _, q in best_asks[:depth])
    return (
        float(best_bids[0][0]),
        best_bids[0][1],
        float(best_asks[0][0]),
        best_asks[0][1],
        round(bid_volume / (bid_volume + ask_volume), 9),
    )


def quotes_of(ticker):
    rows = ticker.collect()
    got = {
        (r["symbol"], r["last_update_id"]): (
            r["best_bid_price"],
            r["best_bid_qty"],
            r["best_ask_price"],
            r["best_ask_qty"],
            round(r["imbalance"], 9),
        )
        for r in rows
    }
    assert len(got) == len(rows)
    return got


def random_diffs(seed, n=300, symbols=("hot", "hot", "cold", "rare"), late=True):
    """Deletes, re-adds, equal prices under different texts, stale ids and late rows."""
    rng = random.Random(seed)
    rows, ids = [], {}
    for offset in range(n):
        symbol = rng.choice(symbols)
        u = ids.get(symbol, 0) + rng.choice([1, 1, 1, 2, -2, 0])
        ids[symbol] = max(ids.get(symbol, 0), u)
        levels = []
        for base in (100, 101):
            side = []
            for _ in range(rng.randint(0, 3)):
                step = rng.randint(0, 4)
                price = base - step if base == 100 else base + step
                text = rng.choice([f"{price}", f"{price}.0", f"{price}.00"])
                side.append((text, rng.choice(["0", "0.00000000", "1", "2.5", "7"])))
            levels.append(side)
        lag = rng.choice([0, 5, 30, 30.001, 90]) if late and rng.random() < 0.2 else 0
        rows.append(diff(u, levels[0], levels[1], offset=offset, symbol=symbol, lag=lag, ts=at(offset)))
    return rows
