"""Latest-state marts over the ticker table.  Every "now" is the ``as_of`` argument."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidebook.functions import market
from tidebook.functions.clock import as_of_column, seconds_between
from tidebook.operators.blocks import KEYS
from tidebook.operators.latest import latest_by

# Newest event first; equal times resolve to the later topic position.
RECENCY = ["exchange_event_ts", "kafka_partition", "kafka_offset"]


def _latest_ticks(ticks: DataFrame, *columns: str) -> DataFrame:
    return latest_by(ticks.select(*KEYS, *RECENCY, *columns), KEYS, RECENCY).withColumnRenamed(
        "exchange_event_ts", "latest_ts"
    )


def spread_metrics(ticks: DataFrame) -> DataFrame:
    """Latest quote per instrument with the spread in basis points of the mid."""
    columns = ["best_bid_price", "best_ask_price", "spread", "mid_price", "best_bid_qty", "best_ask_qty"]
    return _latest_ticks(ticks, *columns).select(
        *KEYS,
        "latest_ts",
        "best_bid_price",
        "best_ask_price",
        "spread",
        "mid_price",
        market.spread_bps(F.col("spread"), F.col("mid_price")).alias("spread_bps"),
        "best_bid_qty",
        "best_ask_qty",
    )


def imbalance_signal(
    ticks: DataFrame, buy: float = market.BUY_ABOVE, sell: float = market.SELL_BELOW
) -> DataFrame:
    return _latest_ticks(ticks, "best_bid_qty", "best_ask_qty", "imbalance").select(
        *KEYS,
        "latest_ts",
        "best_bid_qty",
        "best_ask_qty",
        "imbalance",
        market.market_signal(F.col("imbalance"), buy, sell).alias("market_signal"),
    )


def freshness_status(
    ticks: DataFrame,
    as_of=None,
    fresh: int = market.FRESH_SECONDS,
    warn: int = market.WARN_SECONDS,
) -> DataFrame:
    """Newest event and ingest time per instrument, their age at ``as_of`` and its label."""
    newest = ticks.groupBy(*KEYS).agg(
        F.max("exchange_event_ts").alias("latest_event_ts"), F.max("ingest_ts").alias("latest_ingest_ts")
    )
    return newest.withColumn(
        "staleness_seconds", seconds_between(F.col("latest_event_ts"), as_of_column(as_of))
    ).withColumn("freshness_status", market.freshness_label(F.col("staleness_seconds"), fresh, warn))


def exchange_health(
    ticks: DataFrame,
    as_of=None,
    fresh: int = market.FRESH_SECONDS,
    warn: int = market.WARN_SECONDS,
) -> DataFrame:
    return freshness_status(ticks, as_of, fresh, warn).withColumn(
        "health_score", market.health_score(F.col("staleness_seconds"), fresh, warn)
    )


def liquidity(
    ticks: DataFrame,
    as_of=None,
    fresh: int = market.FRESH_SECONDS,
    warn: int = market.WARN_SECONDS,
) -> DataFrame:
    """Spread, imbalance and freshness per instrument in one pass.

    All three come from the instrument's latest row, so no join is needed; ``join_liquidity``
    is the three-relation form for relations that are already stored.
    """
    columns = [
        "best_bid_price",
        "best_ask_price",
        "spread",
        "mid_price",
        "best_bid_qty",
        "best_ask_qty",
        "imbalance",
    ]
    age = F.col("staleness_seconds")
    return (
        _latest_ticks(ticks, *columns)
        .withColumn("staleness_seconds", seconds_between(F.col("latest_ts"), as_of_column(as_of)))
        .select(
            *KEYS,
            "latest_ts",
            "best_bid_price",
            "best_ask_price",
            "spread",
            "mid_price",
            market.spread_bps(F.col("spread"), F.col("mid_price")).alias("spread_bps"),
            "best_bid_qty",
            "best_ask_qty",
            "imbalance",
            market.market_signal(F.col("imbalance")).alias("market_signal"),
            "staleness_seconds",
            market.freshness_label(age, fresh, warn).alias("freshness_status"),
        )
    )


def join_liquidity(spread: DataFrame, signal: DataFrame, freshness: DataFrame) -> DataFrame:
    """Left joins on the instrument; each relation has one row per instrument."""
    return (
        spread.join(signal.select(*KEYS, "imbalance", "market_signal"), KEYS, "left")
        .join(freshness.select(*KEYS, "staleness_seconds", "freshness_status"), KEYS, "left")
        .select(
            *spread.columns, "imbalance", "market_signal", "staleness_seconds", "freshness_status"
        )
    )


def sla_breaches(ticks: DataFrame, as_of=None, threshold: int = market.SLA_SECONDS) -> DataFrame:
    """Symbols whose newest tick is older than ``threshold`` seconds, stalest first."""
    age = seconds_between(F.col("_newest"), as_of_column(as_of))
    return (
        ticks.groupBy("symbol")
        .agg(F.max("exchange_event_ts").alias("_newest"))
        .select("symbol", age.alias("staleness_s"))
        .where(F.col("staleness_s") > threshold)
        .orderBy(F.desc("staleness_s"), "symbol")
    )


def lag_rollup(health: DataFrame, as_of=None) -> DataFrame:
    """How many instruments are fresh, of how many, checked when."""
    return health.agg(
        F.count_if(F.col("freshness_status") == market.FRESHNESS[0]).alias("healthy_count"),
        F.count(F.lit(1)).alias("total_count"),
    ).withColumn("checked_at", as_of_column(as_of))


def symbol_counts(ticks: DataFrame) -> DataFrame:
    return ticks.groupBy("symbol").agg(F.count(F.lit(1)).alias("ticks")).orderBy(F.desc("ticks"), "symbol")


def signed(df: DataFrame, column: str = "imbalance") -> DataFrame:
    return df.withColumn("signed_imbalance", market.signed_imbalance(F.col(column)))
