"""Price, spread and label columns shared by batch, stream and marts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Labels and cut-offs of the data model.
TOP_DEPTH = 5
NEUTRAL_IMBALANCE = 0.5
BUY_ABOVE = 0.6
SELL_BELOW = 0.4
FRESH_SECONDS = 60
WARN_SECONDS = 120
SLA_SECONDS = 35
LATE_SECONDS = 30
SIGNALS = ["BUY_PRESSURE", "SELL_PRESSURE", "NEUTRAL"]
FRESHNESS = ["FRESH", "WARN", "STALE"]


def spread(bid: Column, ask: Column) -> Column:
    return ask - bid


def mid_price(bid: Column, ask: Column) -> Column:
    return (bid + ask) / F.lit(2.0)


def spread_bps(spread_col: Column, mid: Column) -> Column:
    return F.round(spread_col / F.nullif(mid, F.lit(0.0)) * F.lit(10000), 4)


def imbalance(bid_volume: Column, ask_volume: Column) -> Column:
    """Share of the bid side in the volume of both sides, 0..1; neutral when there is none."""
    total = bid_volume + ask_volume
    return F.when(total > 0, bid_volume / total).otherwise(F.lit(NEUTRAL_IMBALANCE))


def signed_imbalance(share: Column) -> Column:
    """The same measure on the -1..+1 scale."""
    return share * F.lit(2.0) - F.lit(1.0)


def market_signal(share: Column, buy: float = BUY_ABOVE, sell: float = SELL_BELOW) -> Column:
    return (
        F.when(share > buy, F.lit(SIGNALS[0])).when(share < sell, F.lit(SIGNALS[1])).otherwise(F.lit(SIGNALS[2]))
    )


def freshness_label(age: Column, fresh: int = FRESH_SECONDS, warn: int = WARN_SECONDS) -> Column:
    return (
        F.when(age <= fresh, F.lit(FRESHNESS[0]))
        .when(age <= warn, F.lit(FRESHNESS[1]))
        .otherwise(F.lit(FRESHNESS[2]))
    )


def health_score(age: Column, fresh: int = FRESH_SECONDS, warn: int = WARN_SECONDS) -> Column:
    return F.when(age <= fresh, F.lit(1.0)).when(age <= warn, F.lit(0.5)).otherwise(F.lit(0.0))


def event_key(exchange: Column, symbol: Column, last_update_id: Column) -> Column:
    return F.concat_ws("#", exchange, symbol, last_update_id.cast("string"))


def routing_key(exchange: Column, symbol: Column) -> Column:
    """Message key: equal keys go to one topic partition, which keeps their order."""
    return F.concat_ws("#", exchange, symbol)
