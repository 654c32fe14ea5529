"""Bars, latest-state marts and read queries."""

from __future__ import annotations

from datetime import date, datetime

import pytest
from helpers import at, tick, ticks
from pyspark.sql import functions as F

from tidebook.functions import market
from tidebook.functions.clock import epoch_ms, parse_instant
from tidebook.operators.bars import ohlcv, roll_up
from tidebook.plans import backfill, marts, serving

AS_OF = at(1000)


def _one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


def test_bar_follows_event_time_not_arrival(spark):
    rows = [tick("a", 30, 200.0, 3.0, u=1), tick("a", 10, 100.0, 2.0, u=2), tick("a", 50, 150.0, 0.0, u=3)]
    bar = _one(ohlcv(ticks(spark, rows)))
    assert (bar["open_price"], bar["high_price"], bar["low_price"], bar["close_price"]) == (100.0, 200.0, 100.0, 150.0)
    assert (bar["volume"], bar["vwap"], bar["tick_count"]) == (5.0, 160.0, 3)
    assert bar["first_ts"] < bar["last_ts"]


def test_equal_times_resolve_by_update_id(spark):
    rows = [tick("a", 10, m, u=u) for u, m in ((5, 105.0), (3, 103.0), (9, 109.0), (4, 104.0))]
    bar = _one(ohlcv(ticks(spark, rows)))
    assert (bar["open_price"], bar["close_price"]) == (103.0, 109.0)


def test_vwap_without_volume(spark):
    rows = [tick("a", 1, 100.0, 0.0), tick("a", 2, 200.0, None, u=2), tick("a", 3, 240.0, 0.0, u=3)]
    df = ticks(spark, rows)
    assert _one(ohlcv(df))["vwap"] == 180.0
    assert _one(ohlcv(df, vwap_mode="close"))["vwap"] == 240.0
    weighted = ticks(spark, [tick("a", 1, 100.0, 1.0), tick("a", 2, 200.0, 3.0, u=2)])
    assert _one(ohlcv(weighted))["vwap"] == 175.0
    assert _one(ohlcv(weighted, vwap_mode="avg"))["vwap"] == 150.0
    with pytest.raises(ValueError):
        ohlcv(df, vwap_mode="median")


def test_windows_are_half_open_and_nulls_skipped(spark):
    rows = [tick("a", 0, 1.0), tick("a", 59.999, 2.0, u=2), tick("a", 60, 3.0, u=3), tick("a", 61, None, u=4)]
    bars = ohlcv(ticks(spark, rows)).orderBy("window_start").collect()
    assert [b["tick_count"] for b in bars] == [2, 1]


def test_roll_up_equals_coarse_bars(spark):
    rows = [tick("ab"[i % 2], 7 * i, 100.0 + (i * 37) % 11, float(i % 4), u=i) for i in range(120)]
    df = ticks(spark, rows)
    exact = ["exchange", "symbol", "window_start", "open_price", "high_price", "low_price", "close_price", "tick_count", "first_ts", "last_ts"]
    fine, coarse = (x.orderBy("symbol", "window_start").collect() for x in (roll_up(ohlcv(df), "5 minutes"), ohlcv(df, "5 minutes")))
    assert [[r[c] for c in exact] for r in fine] == [[r[c] for c in exact] for r in coarse]
    assert [r["vwap"] for r in fine] == pytest.approx([r["vwap"] for r in coarse])


def test_backfill_bounds():
    with pytest.raises(ValueError):
        backfill.check_dates(date(2024, 1, 2), date(2024, 1, 2))
    with pytest.raises(ValueError):
        backfill.check_dates(date(2024, 1, 1), date(2024, 4, 1))
    backfill.check_dates(date(2024, 1, 1), date(2024, 3, 31))


def test_latest_row_and_its_ties(spark):
    rows = [tick("a", 10, 100.0, u=1, offset=1), tick("a", 10, 101.0, u=2, offset=2), tick("a", 5, 99.0, u=3, offset=3)]
    row = _one(marts.spread_metrics(ticks(spark, rows)))
    assert row["mid_price"] == 101.0
    assert row["spread_bps"] == round(0.2 / 101.0 * 10000, 4)
    zero = _one(marts.spread_metrics(ticks(spark, [tick("a", 1, 0.0)])))
    assert zero["spread_bps"] is None


@pytest.mark.parametrize(
    "share,signal", [(0.61, "BUY_PRESSURE"), (0.6, "NEUTRAL"), (0.4, "NEUTRAL"), (0.39, "SELL_PRESSURE"), (None, "NEUTRAL")]
)
def test_signal_bounds_are_strict(spark, share, signal):
    assert _one(marts.imbalance_signal(ticks(spark, [tick("a", 1, 10.0, imbalance=share)])))["market_signal"] == signal


@pytest.mark.parametrize("age,label,score", [(60, "FRESH", 1.0), (61, "WARN", 0.5), (120, "WARN", 0.5), (121, "STALE", 0.0)])
def test_freshness_bounds_are_inclusive(spark, age, label, score):
    row = _one(marts.exchange_health(ticks(spark, [tick("a", 1000 - age, 10.0)]), AS_OF))
    assert (row["staleness_seconds"], row["freshness_status"], row["health_score"]) == (age, label, score)


def test_staleness_counts_complete_seconds(spark):
    row = _one(marts.freshness_status(ticks(spark, [tick("a", 998.1, 10.0, u=1)]), AS_OF))
    assert row["staleness_seconds"] == 1


def test_liquidity_equals_join_of_its_parts(spark):
    rows = [tick(s, t, 100.0 + t, imbalance=t / 1000, u=t) for s in "abc" for t in range(880, 1000, 17)]
    df = ticks(spark, rows)
    joined = marts.join_liquidity(marts.spread_metrics(df), marts.imbalance_signal(df), marts.freshness_status(df, AS_OF))
    single = marts.liquidity(df, AS_OF)
    assert single.columns == joined.columns and len(single.columns) == 14
    assert sorted(single.collect()) == sorted(joined.collect())


def test_join_keeps_instruments_without_signal(spark):
    df = ticks(spark, [tick("a", 10, 100.0), tick("b", 10, 100.0)])
    signal = marts.imbalance_signal(df).where("symbol = 'a'")
    joined = marts.join_liquidity(marts.spread_metrics(df), signal, marts.freshness_status(df, AS_OF))
    row = joined.where("symbol = 'b'").first()
    assert row["imbalance"] is None and row["freshness_status"] == "STALE"
    assert serving.liquidity_snapshot(joined).where("symbol = 'b'").first()["imbalance"] == 0.0


def test_sla_breaches(spark):
    df = ticks(spark, [tick("a", 880, 1.0), tick("b", 955, 1.0), tick("c", 965, 1.0), tick("d", 999, 1.0)])
    assert [tuple(r) for r in marts.sla_breaches(df, AS_OF).collect()] == [("a", 120), ("b", 45)]


def test_rollup_of_health(spark):
    df = ticks(spark, [tick("a", 990, 1.0), tick("b", 900, 1.0), tick("c", 1, 1.0)])
    row = _one(marts.lag_rollup(marts.exchange_health(df, AS_OF), AS_OF))
    assert (row["healthy_count"], row["total_count"]) == (1, 3)


def _bars(spark, n=100):
    return ohlcv(ticks(spark, [tick("BtcUsdt", 60 * i, 100.0 + i, u=i) for i in range(n)]))


def test_recent_and_newest_bars(spark):
    bars = _bars(spark)
    recent = serving.recent_bars(bars, at(60 * 100)).collect()
    assert len(recent) == 60 and recent[0]["open_price"] == 199.0
    assert recent == sorted(recent, key=lambda r: r["window_start"], reverse=True)
    newest = serving.newest_bars(bars, "btcusdt", 3, at(60 * 100)).collect()
    assert [r["open_price"] for r in newest] == [199.0, 198.0, 197.0]
    counted = serving.bars_with_count(serving.recent_bars(bars, at(60 * 100), hours=1, n=5)).collect()
    assert {(r["symbol"], r["count"]) for r in counted} == {("BTCUSDT", 5)}
    with pytest.raises(ValueError):
        serving.newest_bars(bars, "btcusdt", 61)


def test_historical_bars(spark):
    bars = _bars(spark)
    rows = serving.historical_bars(bars, "BTCUSDT", at(600), at(900), 1440).collect()
    assert [r["open_price"] for r in rows] == [114.0, 113.0, 112.0, 111.0, 110.0]
    assert serving.historical_bars(bars, "nope").count() == 0
    for bad in (0, 1441):
        with pytest.raises(ValueError):
            serving.historical_bars(bars, "BTCUSDT", limit=bad)


def test_gauges(spark):
    df = ticks(spark, [tick("Btc", 990, 100.0)])
    rows = serving.gauge_feed(marts.liquidity(df, AS_OF), marts.exchange_health(df, AS_OF)).collect()
    assert {(r["symbol"], r["metric"]) for r in rows} == {
        ("btc", "market_mid_price_usd"),
        ("btc", "market_spread_bps"),
        ("btc", "market_bid_ask_imbalance"),
        ("btc", "market_staleness_seconds"),
        ("Btc", "pipeline_health_score"),
    }


@pytest.mark.parametrize(
    "text,ms",
    [
        ("1704067200123", 1704067200123),
        ("1704067200123.9", 1704067200123),
        ("2024-01-01T00:00:00.123Z", 1704067200123),
        ("2024-01-01T00:00:00.1239Z", 1704067200123),
        ("2024-01-01T02:00:00+02:00", 1704067200000),
        ("2024-01-01T00:00:00", 1704067200000),
        ("12:30:00", None),
        ("soon", None),
        ("", None),
        (None, None),
    ],
)
def test_epoch_coercion(spark, text, ms):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(epoch_ms(F.col("t"))).first()[0] == ms


def test_parse_instant(spark):
    df = spark.createDataFrame([("2024-01-01T00:00:00Z",), ("1704067200",), ("1704067200.5",), ("x",)], "t string")
    seconds = [r[0] for r in df.select(F.unix_micros(parse_instant(F.col("t")))).collect()]
    assert seconds == [1704067200_000000, 1704067200_000000, 1704067200_500000, None]


def test_signed_imbalance_scale(spark):
    got = spark.range(1).select(market.signed_imbalance(F.lit(0.6)), market.signed_imbalance(F.lit(0.0))).first()
    assert got[0] == pytest.approx(0.2) and got[1] == -1.0


def test_naive_datetime_is_utc(spark):
    from tidebook.functions.clock import instant

    got = spark.range(1).select(F.unix_seconds(instant(datetime(2024, 1, 1)))).first()[0]
    assert got == 1704067200
