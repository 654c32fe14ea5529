"""Event-time OHLCV bars: one definition for batch, backfill, roll-up and stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidebook.operators.blocks import KEYS

# How volume-weighted price falls back: "tick" averages mids when there is no volume (the
# canonical bar), "close" takes the closing mid, "avg" is always the unweighted mean.
VWAP_MODES = ("tick", "close", "avg")


def _vwap(mode: str, weighted: Column, volume: Column, mean: Column, close: Column) -> Column:
    if mode not in VWAP_MODES:
        raise ValueError(f"vwap_mode must be one of {VWAP_MODES}")
    if mode == "avg":
        return mean
    return F.when(volume > 0, weighted / volume).otherwise(close if mode == "close" else mean)


def ohlcv(
    ticks: DataFrame,
    interval: str = "1 minute",
    vwap_mode: str = "tick",
    time_column: str = "exchange_event_ts",
) -> DataFrame:
    """Bars per (exchange, symbol, tumbling window) of ticks that have a mid price.

    Open and close follow event time; ``last_update_id`` breaks ties.  All aggregates combine
    before the shuffle, so a hot instrument costs one row per bar and task.  On a stream with a
    watermark the same plan emits every bar once, after its window closes.
    """
    ts = F.col(time_column)
    arrival = F.struct(ts, F.col("last_update_id"))
    qty = F.coalesce(F.col("best_bid_qty"), F.lit(0.0))
    mid = F.col("mid_price")
    grouped = (
        ticks.where(mid.isNotNull())
        .groupBy(*KEYS, F.window(ts, interval).alias("_w"))
        .agg(
            F.min_by(mid, arrival).alias("open_price"),
            F.max(mid).alias("high_price"),
            F.min(mid).alias("low_price"),
            F.max_by(mid, arrival).alias("close_price"),
            F.sum(qty).alias("volume"),
            F.sum(mid * qty).alias("_weighted"),
            F.avg(mid).alias("_mean"),
            F.count(F.lit(1)).alias("tick_count"),
            F.min(ts).alias("first_ts"),
            F.max(ts).alias("last_ts"),
        )
    )
    return grouped.select(
        *KEYS,
        F.col("_w.start").alias("window_start"),
        F.col("_w.end").alias("window_end"),
        "open_price",
        "high_price",
        "low_price",
        "close_price",
        "volume",
        _vwap(vwap_mode, F.col("_weighted"), F.col("volume"), F.col("_mean"), F.col("close_price")).alias("vwap"),
        "tick_count",
        "first_ts",
        "last_ts",
    )


# A partial bar: order keys stay beside open and close, sums stay sums, so that parts of a window merge
# in any order and grouping.  Sums are decimals of ten places: exact, where sums of doubles depend on the order.
_SUMS = ["volume", "weighted", "mid_sum", "tick_count"]
_EXACT = "decimal(38,10)"


def partial_bars(
    ticks: DataFrame, interval: str = "1 minute", time_column: str = "exchange_event_ts", by: tuple[str, ...] = ()
) -> DataFrame:
    """Mergeable state of the bars of some ticks, one row per (``by``, exchange, symbol, window)."""
    ts, mid = F.col(time_column), F.col("mid_price")
    qty = F.coalesce(F.col("best_bid_qty"), F.lit(0.0))
    # Equal (time, id) keep the lowest mid as open and the highest as close, whatever the parts are.
    arrival = F.struct(ts.alias("ts"), F.col("last_update_id").alias("id"), mid.alias("price"))
    return (
        ticks.where(mid.isNotNull())
        .groupBy(*by, *KEYS, F.window(ts, interval).alias("_w"))
        .agg(
            F.min(arrival).alias("open"),
            F.max(arrival).alias("close"),
            F.max(mid).alias("high_price"),
            F.min(mid).alias("low_price"),
            F.sum(qty.cast(_EXACT)).alias("volume"),
            F.sum((mid * qty).cast(_EXACT)).alias("weighted"),
            F.sum(mid.cast(_EXACT)).alias("mid_sum"),
            F.count(F.lit(1)).alias("tick_count"),
        )
        .select(
            *by,
            *KEYS,
            F.col("_w.start").alias("window_start"),
            F.col("_w.end").alias("window_end"),
            "open",
            "close",
            "high_price",
            "low_price",
            *_SUMS,
        )
    )


def merge_partials(partials: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Partial bars of the same window as one; associative and commutative, combined before the shuffle."""
    return partials.groupBy(*by, *KEYS, "window_start", "window_end").agg(
        F.min("open").alias("open"),
        F.max("close").alias("close"),
        F.max("high_price").alias("high_price"),
        F.min("low_price").alias("low_price"),
        *[F.sum(c).alias(c) for c in _SUMS],
    )


def finish_bars(partials: DataFrame, vwap_mode: str = "tick") -> DataFrame:
    """Bars from merged partial bars."""
    close = F.col("close.price")
    volume, weighted, mid_sum = (F.col(c).cast("double") for c in _SUMS[:3])
    mean = mid_sum / F.col("tick_count")
    return partials.select(
        *KEYS,
        "window_start",
        "window_end",
        F.col("open.price").alias("open_price"),
        "high_price",
        "low_price",
        close.alias("close_price"),
        volume.alias("volume"),
        _vwap(vwap_mode, weighted, volume, mean, close).alias("vwap"),
        "tick_count",
        F.col("open.ts").alias("first_ts"),
        F.col("close.ts").alias("last_ts"),
    )


def roll_up(bars: DataFrame, interval: str, vwap_mode: str = "tick") -> DataFrame:
    """Coarser bars from finer ones, exact for every field; unweighted means weigh by tick count."""
    start, vwap = F.col("window_start"), F.col("vwap")
    grouped = bars.groupBy(*KEYS, F.window(start, interval).alias("_w")).agg(
        F.min_by("open_price", start).alias("open_price"),
        F.max("high_price").alias("high_price"),
        F.min("low_price").alias("low_price"),
        F.max_by("close_price", start).alias("close_price"),
        F.sum("volume").alias("volume"),
        F.sum(vwap * F.col("volume")).alias("_weighted"),
        (F.sum(vwap * F.col("tick_count")) / F.sum("tick_count")).alias("_mean"),
        F.sum("tick_count").alias("tick_count"),
        F.min("first_ts").alias("first_ts"),
        F.max("last_ts").alias("last_ts"),
    )
    return grouped.select(
        *KEYS,
        F.col("_w.start").alias("window_start"),
        F.col("_w.end").alias("window_end"),
        "open_price",
        "high_price",
        "low_price",
        "close_price",
        "volume",
        _vwap(vwap_mode, F.col("_weighted"), F.col("volume"), F.col("_mean"), F.col("close_price")).alias("vwap"),
        "tick_count",
        "first_ts",
        "last_ts",
    )


def recent_per_symbol(bars: DataFrame, n: int = 60, keys: tuple[str, ...] = ("symbol",)) -> DataFrame:
    """Newest ``n`` bars per symbol (or other keys) with their rank.  Spark cuts each task to ``n`` before the shuffle."""
    from pyspark.sql import Window

    newest = Window.partitionBy(*keys).orderBy(F.desc("window_start"), F.asc("exchange"))
    return bars.withColumn("rn", F.row_number().over(newest)).where(F.col("rn") <= n)
