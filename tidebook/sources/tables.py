"""Table scans with filters and columns pushed to the Parquet reader."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidebook.functions.clock import as_of_column, instant
from tidebook.schemas import BOOK_TICKER, OHLCV_BAR, SYMBOL_CONFIG

# Registered tables: schema, columns holding the row's time and its load time, partition columns.
DAY = ["exchange", "symbol", "event_date"]
TABLES = {
    "book_ticker": {"schema": BOOK_TICKER, "time": "exchange_event_ts", "loaded_at": "ingest_ts", "partitions": DAY},
    "ohlcv_1m": {"schema": OHLCV_BAR, "time": "last_ts", "loaded_at": "last_ts", "partitions": DAY},
    "symbol_config": {"schema": SYMBOL_CONFIG, "time": "updated_at", "loaded_at": "updated_at", "partitions": []},
}


def read_table(spark: SparkSession, path: str, schema=None) -> DataFrame:
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(path)


def register_tables(spark: SparkSession, paths: dict[str, str]) -> None:
    """Expose the given table folders to SQL under their names."""
    for name, path in paths.items():
        read_table(spark, path, TABLES[name]["schema"]).createOrReplaceTempView(name)


# Columns whose date is the partition date of a stored table.
DATED = ("exchange_event_ts", "window_start")


def since_date(df: DataFrame, column: str, bound) -> DataFrame:
    """Also bounds ``event_date`` from below where the table has it, so that older folders are not listed."""
    if column in DATED and "event_date" in df.columns:
        return df.where(F.col("event_date") >= F.to_date(bound))
    return df


def until_date(df: DataFrame, column: str, bound) -> DataFrame:
    """Also bounds ``event_date`` from above where the table has it."""
    if column in DATED and "event_date" in df.columns:
        return df.where(F.col("event_date") <= F.to_date(bound))
    return df


def time_range(df: DataFrame, start, end, column: str = "exchange_event_ts", symbol: str | None = None) -> DataFrame:
    """Rows with ``start <= column < end``, optionally of one symbol; either bound may be ``None``."""
    if start is not None:
        df = since_date(df.where(F.col(column) >= instant(start)), column, instant(start))
    if end is not None:
        df = until_date(df.where(F.col(column) < instant(end)), column, instant(end))
    if symbol is not None:
        df = df.where(F.col("symbol") == symbol)
    return df


def recent(df: DataFrame, minutes: int, as_of=None, column: str = "exchange_event_ts", limit: int | None = None) -> DataFrame:
    """Rows newer than ``minutes`` before ``as_of``; ``limit`` gives the bounded sample."""
    since = as_of_column(as_of) - F.make_dt_interval(mins=F.lit(minutes))
    rows = since_date(df.where(F.col(column) > since), column, since)
    return rows if limit is None else rows.limit(limit)
