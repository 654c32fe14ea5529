"""Recompute bars of a date range and replace the instrument days that it gives."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame

from tidebook.operators.bars import ohlcv
from tidebook.sinks.tables import BAR_PARTITIONS, overwrite_partitions, with_event_date
from tidebook.sources.tables import time_range

MAX_DAYS = 90  # fixed value: longest range one run accepts


def check_dates(start: date, end: date) -> None:
    if end <= start:
        raise ValueError(f"end date {end} must be after start date {start}")
    if end - start > timedelta(days=MAX_DAYS):
        raise ValueError(f"a backfill covers at most {MAX_DAYS} days, not {(end - start).days}")


def backfill_bars(
    ticks: DataFrame, start: date, end: date, interval: str = "1 minute", vwap_mode: str = "tick"
) -> DataFrame:
    """Bars of ticks in ``[start, end)`` with their ``event_date``."""
    check_dates(start, end)
    bars = ohlcv(time_range(ticks, str(start), str(end)), interval, vwap_mode)
    return with_event_date(bars, "window_start")


def run_backfill(
    ticks: DataFrame,
    path: str,
    start: date,
    end: date,
    interval: str = "1 minute",
    vwap_mode: str = "tick",
) -> None:
    """Instrument days with ticks in the range are replaced; a day without ticks keeps what it has."""
    overwrite_partitions(backfill_bars(ticks, start, end, interval, vwap_mode), path, BAR_PARTITIONS)
