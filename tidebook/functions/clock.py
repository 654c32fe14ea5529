"""Time columns.  "Now" is always a parameter so that results can be reproduced."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F


def instant(value: Column | datetime | str) -> Column:
    """A timestamp column from a column, a datetime (naive means UTC), ISO-8601 text or epoch seconds."""
    if isinstance(value, Column):
        return value
    if isinstance(value, datetime):
        if value.tzinfo is None:
            value = value.replace(tzinfo=timezone.utc)
        return F.lit(value.astimezone(timezone.utc).strftime("%Y-%m-%dT%H:%M:%S.%fZ")).cast("timestamp")
    return parse_instant(F.lit(str(value)))


def as_of_column(as_of: Column | datetime | str | None = None) -> Column:
    return F.current_timestamp() if as_of is None else instant(as_of)


def parse_instant(text: Column) -> Column:
    """ISO-8601 text or epoch seconds to a timestamp; null when neither fits."""
    return F.coalesce(_iso(text), F.timestamp_micros((_number(text) * 1_000_000).cast("long")))


def epoch_ms(text: Column, default: Column | None = None) -> Column:
    """Epoch milliseconds from text holding a number (already ms) or ISO-8601; truncating."""
    parsed = F.coalesce(
        F.when(text.rlike(r"^\s*-?\d+\s*$"), text.try_cast("long")),
        _number(text).cast("long"),
        F.unix_millis(_iso(text)),
    )
    return parsed if default is None else F.coalesce(parsed, F.unix_millis(default))


def seconds_between(start: Column, end: Column) -> Column:
    """Complete seconds elapsed from ``start`` to ``end``."""
    return F.timestamp_diff("SECOND", start, end)


def _number(text: Column) -> Column:
    return F.when(text.rlike(r"^\s*-?\d+(\.\d+)?([eE][+-]?\d{1,2})?\s*$"), text.try_cast("double"))


def _iso(text: Column) -> Column:
    # A bare time of day would be read as "today", so a full date is required.
    return F.when(text.rlike(r"^\s*\d{4}-\d{2}-\d{2}"), F.try_to_timestamp(text))
