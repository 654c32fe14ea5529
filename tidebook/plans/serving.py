"""Read queries behind the dashboards: DataFrames in, DataFrames out."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidebook.functions.clock import as_of_column, instant
from tidebook.operators.bars import recent_per_symbol
from tidebook.plans.marts import lag_rollup
from tidebook.schemas import OHLCV_BAR, names
from tidebook.sources.tables import since_date, until_date

# Fixed values of the read interface.
PRELOADED_BARS = 60
MAX_BARS = 1440
RECENT_HOURS = 2
GAUGES = {
    "mid_price": "market_mid_price_usd",
    "spread_bps": "market_spread_bps",
    "imbalance": "market_bid_ask_imbalance",
    "staleness_seconds": "market_staleness_seconds",
    "health_score": "pipeline_health_score",
}
SPREAD_COLUMNS = [
    "exchange",
    "symbol",
    "latest_ts",
    "best_bid_price",
    "best_ask_price",
    "spread",
    "mid_price",
    "spread_bps",
]


def _symbol_is(symbol: str):
    return F.upper("symbol") == symbol.upper()


def liquidity_snapshot(liquidity: DataFrame) -> DataFrame:
    """All instruments; a missing imbalance reads as zero."""
    return liquidity.withColumn("imbalance", F.coalesce("imbalance", F.lit(0.0)))


def spread_for(liquidity: DataFrame, symbol: str) -> DataFrame:
    return liquidity.where(_symbol_is(symbol)).select(*SPREAD_COLUMNS)


def liquidity_for(liquidity: DataFrame, symbol: str) -> DataFrame:
    return liquidity_snapshot(liquidity.where(_symbol_is(symbol)))


def recent_bars(
    bars: DataFrame,
    as_of=None,
    hours: int = RECENT_HOURS,
    n: int = PRELOADED_BARS,
    by_exchange: bool = False,
) -> DataFrame:
    """Newest ``n`` bars per symbol that started within ``hours`` of ``as_of``, newest first."""
    since = as_of_column(as_of) - F.make_dt_interval(hours=F.lit(hours))
    keys = ("exchange", "symbol") if by_exchange else ("symbol",)
    return (
        recent_per_symbol(since_date(bars.where(F.col("window_start") >= since), "window_start", since), n, keys)
        .orderBy("symbol", F.desc("window_start"), "exchange")
        .select(*names(OHLCV_BAR))
    )


def bars_with_count(recent: DataFrame) -> DataFrame:
    """Recent bars under the upper-case symbol, each with its symbol's bar count."""
    counted = recent.withColumn("symbol", F.upper("symbol"))
    return counted.withColumn("count", F.count(F.lit(1)).over(Window.partitionBy("symbol")))


def newest_bars(bars: DataFrame, symbol: str, limit: int = PRELOADED_BARS, as_of=None) -> DataFrame:
    """The newest ``limit`` (at most 60) recent bars of one symbol."""
    if not 1 <= limit <= PRELOADED_BARS:
        raise ValueError(f"limit must be within 1..{PRELOADED_BARS}")
    of_symbol = recent_bars(bars.where(_symbol_is(symbol)), as_of)
    return of_symbol.orderBy(F.desc("window_start"), "exchange").limit(limit)


def historical_bars(
    bars: DataFrame, symbol: str, start=None, end=None, limit: int = PRELOADED_BARS
) -> DataFrame:
    """Bars of one symbol (any case) within optional bounds, newest first."""
    if not 1 <= limit <= MAX_BARS:
        raise ValueError(f"limit must be within 1..{MAX_BARS}")
    rows = bars.where(F.lower("symbol") == symbol.lower())
    if start is not None:
        rows = since_date(rows.where(F.col("window_start") >= instant(start)), "window_start", instant(start))
    if end is not None:
        # A bar starts no later than it ends.
        rows = until_date(rows.where(F.col("window_end") <= instant(end)), "window_start", instant(end))
    return rows.orderBy(F.desc("window_start"), "exchange").limit(limit).select(*names(OHLCV_BAR))


def lag_list(health: DataFrame, as_of=None) -> DataFrame:
    """Health rows ordered by symbol, each beside the roll-up counts."""
    totals = lag_rollup(health, as_of)  # an aggregate without keys: exactly one row
    both = totals.select(F.struct("healthy_count", "total_count")).scalar()
    counts = {c: both[c] for c in ("healthy_count", "total_count")}
    return health.withColumns({**counts, "checked_at": as_of_column(as_of)}).orderBy("symbol", "exchange")


def symbol_list(config: DataFrame) -> DataFrame:
    return config.select(
        "symbol", "exchange", "status", "base_asset", "quote_asset", "updated_at"
    ).orderBy("symbol")


def gauge_feed(liquidity: DataFrame, health: DataFrame) -> DataFrame:
    """``(symbol, exchange, metric, value)`` rows for the five gauges.

    Liquidity gauges label the lower-case symbol, the health gauge the symbol as stored.
    """
    market = [c for c in GAUGES if c != "health_score"]
    from_liquidity = (
        liquidity_snapshot(liquidity)
        .select(
            F.lower("symbol").alias("symbol"),
            "exchange",
            *[F.col(c).cast("double").alias(GAUGES[c]) for c in market],
        )
        .unpivot(["symbol", "exchange"], [GAUGES[c] for c in market], "metric", "value")
    )
    from_health = health.select(
        "symbol",
        "exchange",
        F.lit(GAUGES["health_score"]).alias("metric"),
        F.col("health_score").alias("value"),
    )
    return from_liquidity.unionByName(from_health)


def audit_listing(bronze: DataFrame, n: int = 20) -> DataFrame:
    """First ``n`` change events in log order."""
    return bronze.orderBy("source_lsn", "kafka_offset").limit(n).select("op", "symbol", "source_lsn")


def recent_counts(tables: dict[str, tuple[DataFrame, str]], as_of=None, hours: int = RECENT_HOURS) -> DataFrame:
    """Rows newer than ``hours`` per table; ``tables`` maps a name to (rows, time column)."""
    since = as_of_column(as_of) - F.make_dt_interval(hours=F.lit(hours))
    counts = [
        df.where(F.col(column) >= since)
        .agg(F.count(F.lit(1)).alias("recent_rows"))
        .select(F.lit(name).alias("table_name"), "recent_rows")
        for name, (df, column) in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)
