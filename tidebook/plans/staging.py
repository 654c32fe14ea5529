"""Thin projections over the silver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidebook.schemas import BOOK_TICKER, OHLCV_BAR, SYMBOL_CONFIG, names

STG_BOOK_TICKER = [
    c for c in names(BOOK_TICKER) if c not in ("processed_ts", "last_update_id", "first_update_id")
]


def stg_book_ticker(ticks: DataFrame) -> DataFrame:
    return ticks.select(*STG_BOOK_TICKER)


def stg_ohlcv(bars: DataFrame) -> DataFrame:
    return bars.select(*names(OHLCV_BAR))


def stg_symbol_config(config: DataFrame) -> DataFrame:
    return config.select(*names(SYMBOL_CONFIG))


def mart_ohlcv(bars: DataFrame) -> DataFrame:
    return stg_ohlcv(bars)
