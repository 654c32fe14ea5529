"""Replay: time window to offset ranges, bounded re-read, re-publish and statistics."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidebook.functions.clock import as_of_column, instant
from tidebook.operators.blocks import BLOCK, BLOCK_SPAN, with_block
from tidebook.session import settle
from tidebook.sources.tables import time_range

NO_OFFSET = -1  # fixed value: lineage unknown
OPEN_END = 2**63 - 1  # fixed value: read to the end of the partition
SILVER, TOPIC_TIME = "silver", "topic_time"


def default_window(start=None, end=None, as_of=None):
    """``[start, end)``; by default the hour before ``as_of``."""
    end_col = as_of_column(as_of) if end is None else instant(end)
    start_col = as_of_column(as_of) - F.make_dt_interval(hours=F.lit(1)) if start is None else instant(start)
    return start_col, end_col


def default_bounds(spark, start=None, end=None, as_of=None) -> dict:
    """``default_window`` as values, taken once so that every use of a request sees the same bounds."""
    low, high = default_window(start, end, as_of)
    row = spark.range(1).select(low.alias("start"), high.alias("end")).first()
    return row.asDict()


def check_window(start, end) -> None:
    if start >= end:
        raise ValueError(f"replay window start {start} must be before its end {end}")


def _of_symbol(df: DataFrame, symbol: str | None, column) -> DataFrame:
    return df if symbol is None else df.where(F.upper(column) == symbol.upper())


def offset_ranges(ticks: DataFrame, start=None, end=None, symbol: str | None = None) -> DataFrame:
    """Per topic partition the offsets behind the tickers of ``[start, end)``; end is exclusive.

    Rows without lineage are skipped, so a table without any lineage gives no ranges.
    """
    rows = _of_symbol(time_range(ticks, start, end), symbol, F.col("symbol"))
    return (
        rows.where((F.col("kafka_partition") != NO_OFFSET) & (F.col("kafka_offset") != NO_OFFSET))
        .groupBy("kafka_partition")
        .agg(
            F.min("kafka_offset").alias("start_offset"),
            (F.max("kafka_offset") + 1).alias("end_offset"),
        )
        .orderBy("kafka_partition")
    )


def time_offset_ranges(records: DataFrame, start, end) -> DataFrame:
    """Ranges from record times: first offset at or after ``start`` up to the first at or after ``end``.

    No record after ``end`` leaves the range open; partitions with nothing in the window are left out.
    """
    first_at = {
        name: F.min(F.when(F.col("record_ts") >= instant(bound), F.col("kafka_offset")))
        for name, bound in (("start_offset", start), ("_end", end))
    }
    return (
        records.groupBy("kafka_partition")
        .agg(*[expr.alias(name) for name, expr in first_at.items()])
        .withColumn("end_offset", F.coalesce("_end", F.lit(OPEN_END)))
        .where(F.col("start_offset") < F.col("end_offset"))
        .select("kafka_partition", "start_offset", "end_offset")
        .orderBy("kafka_partition")
    )


def replay_ranges(
    ticks: DataFrame, records: DataFrame, start, end, symbol: str | None = None
) -> tuple[DataFrame, str]:
    """Ranges from the ticker table, else from record times, and which of the two was used.

    They are one row for each topic partition, computed once and kept in the shared folder.
    """
    ranges = settle(offset_ranges(ticks, start, end, symbol), "ranges")
    if not ranges.isEmpty():
        return ranges, SILVER
    return settle(time_offset_ranges(records, start, end), "ranges"), TOPIC_TIME


def read_ranges(records: DataFrame, ranges: DataFrame, symbol: str | None = None) -> DataFrame:
    """Records inside the ranges, optionally of one symbol (the part of the key after ``#``)."""
    records = _of_symbol(records, symbol, F.substring_index("key", "#", -1)) if symbol else records
    offset = F.col("kafka_offset")
    return (
        records.join(ranges.select("kafka_partition", "start_offset", "end_offset"), "kafka_partition")
        .where((offset >= F.col("start_offset")) & (offset < F.col("end_offset")))
        .select(*records.columns)
    )


def first_events(records: DataFrame, n: int, span: int = BLOCK_SPAN) -> DataFrame:
    """The first ``n`` records in (partition, offset) order, over all partitions.

    Whole partitions before the cap are kept, then whole blocks of the partition that reaches it; rows
    are ranked inside one block only.
    """
    lane = ["kafka_partition", BLOCK]
    blocked = with_block(records, "kafka_offset", span)
    counts = blocked.groupBy(*lane).agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.orderBy("kafka_partition").rowsBetween(Window.unboundedPreceding, -1)
    # One row for each topic partition.
    starts = counts.groupBy("kafka_partition").agg(F.sum("_n").alias("_all")).select(
        "kafka_partition", F.coalesce(F.sum("_all").over(earlier), F.lit(0)).alias("_start")
    )
    before = Window.partitionBy("kafka_partition").orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    kept = (
        counts.join(starts.where(F.col("_start") < n), "kafka_partition")
        .select(*lane, (F.col("_start") + F.coalesce(F.sum("_n").over(before), F.lit(0))).alias("_before"))
        .where(F.col("_before") < n)
    )
    rank = F.row_number().over(Window.partitionBy(*lane).orderBy("kafka_offset"))
    return (
        blocked.join(kept, lane)
        .withColumn("_rank", rank)
        .where(F.col("_before") + F.col("_rank") <= n)
        .select(*records.columns)
    )


@dataclass(frozen=True)
class ReplayRequest:
    start: object = None
    end: object = None
    symbol: str | None = None
    max_events: int | None = None
    dry_run: bool = False
    source_topic: str = "market.raw.orderbook"
    target_topic: str = "market.raw.orderbook"


def replay_rows(
    ticks: DataFrame, records: DataFrame, request: ReplayRequest
) -> tuple[DataFrame, DataFrame, str]:
    """Records to re-publish for a request, the ranges they lie in, and where those came from."""
    ranges, source = replay_ranges(ticks, records, request.start, request.end, request.symbol)
    rows = read_ranges(records, ranges, request.symbol)
    if request.max_events is not None:
        rows = first_events(rows, request.max_events)
    return rows, ranges, source


def replay_stats(rows: DataFrame, ranges: DataFrame, request: ReplayRequest, offset_source: str) -> DataFrame:
    """One summary row; every partition with a range is listed, at most as many as the topic has."""
    partitions = ranges.agg(F.sort_array(F.collect_set("kafka_partition")).alias("partitions_replayed"))
    return rows.agg(F.count(F.lit(1)).alias("events_read")).select(
        "events_read", partitions.scalar().alias("partitions_replayed")
    ).select(
        F.lit(request.dry_run).alias("dry_run"),
        F.lit(request.source_topic).alias("source_topic"),
        F.lit(request.target_topic).alias("target_topic"),
        instant(request.start).alias("start_ts"),
        instant(request.end).alias("end_ts"),
        F.lit(request.symbol).cast("string").alias("symbol"),
        "events_read",
        (F.lit(0).cast("long") if request.dry_run else F.col("events_read")).alias("events_produced"),
        "partitions_replayed",
        F.lit(offset_source).alias("offset_source"),
    )


def run_replay(ticks: DataFrame, records: DataFrame, request: ReplayRequest, publish) -> DataFrame:
    """Publish the rows unless it is a dry run; ``publish`` takes ``key, value`` rows.

    A bound that is not given comes from the default window, the hour before now.
    """
    if request.start is None or request.end is None:
        request = replace(request, **default_bounds(ticks.sparkSession, request.start, request.end))
    check_window(request.start, request.end)
    rows, ranges, source = replay_rows(ticks, records, request)
    if not request.dry_run:
        publish(rows.select("key", "value"))
    return replay_stats(rows, ranges, request, source)
