"""Update-id rules: monotone dedup, lateness, gaps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidebook.functions.market import LATE_SECONDS
from tidebook.operators.blocks import BLOCK, BLOCK_SPAN, KEYS, running, with_block

ARRIVAL = ["kafka_partition", BLOCK]
ARRIVAL_ORDER = ["kafka_offset", "last_update_id"]


def _with_last_seen(diffs: DataFrame, span: int, folds: int | None = None) -> DataFrame:
    return running(
        with_block(diffs, "kafka_offset", span),
        {"_last_seen": ("max", F.col("last_update_id"))},
        KEYS,
        ARRIVAL,
        ARRIVAL_ORDER,
        folds=folds,
    )


def _fresh():
    return F.col("_last_seen").isNull() | (F.col("last_update_id") > F.col("_last_seen"))


def monotone_dedup(diffs: DataFrame, span: int = BLOCK_SPAN) -> DataFrame:
    """Keep a diff only when its id exceeds every id that arrived before it for the instrument.

    Rejected ids never raise the maximum, so the running maximum of all arrivals equals the
    "last accepted id" of a sequential reader.
    """
    return deduped_blocks(diffs, span).select(*diffs.columns)


def deduped_blocks(diffs: DataFrame, span: int = BLOCK_SPAN, folds: int | None = None) -> DataFrame:
    """``monotone_dedup`` that also keeps ``_last_seen`` and the block columns (``folds``: those of folds, too)."""
    return _with_last_seen(diffs, span, folds).where(_fresh())


def lag_seconds():
    return (F.unix_millis("processed_ts") - F.unix_millis("exchange_event_ts")) / F.lit(1000.0)


def is_late(threshold: float = LATE_SECONDS):
    """Late means strictly more than ``threshold`` seconds behind its processing time."""
    return lag_seconds() > F.lit(float(threshold))


def tag_late(diffs: DataFrame, threshold: float = LATE_SECONDS) -> DataFrame:
    """Mark late diffs as dead letters.  Runs after dedup: a late diff has already used its id."""
    late = is_late(threshold)
    return diffs.withColumn("lag_s", lag_seconds()).withColumn(
        "error_type", F.when(late, F.lit("late_event"))
    )


def classify_sequence(diffs: DataFrame, span: int = BLOCK_SPAN) -> DataFrame:
    """Every diff with ``last_seen_id``, ``is_stale``, ``is_gap`` and ``segment_id``.

    Stale: its last id is not above the highest seen.  Gap: its first id skips past the next
    expected one.  ``segment_id`` counts the gaps of the instrument up to the row.
    """
    seen = _with_last_seen(diffs, span)
    stale = F.col("_last_seen").isNotNull() & (F.col("last_update_id") <= F.col("_last_seen"))
    gap = F.col("_last_seen").isNotNull() & ~stale & (F.col("first_update_id") > F.col("_last_seen") + 1)
    flagged = seen.select(
        *diffs.columns,
        BLOCK,
        F.col("_last_seen").alias("last_seen_id"),
        stale.alias("is_stale"),
        gap.alias("is_gap"),
    )
    return running(
        flagged,
        {"segment_id": ("sum", F.col("is_gap").cast("long"))},
        KEYS,
        ARRIVAL,
        ARRIVAL_ORDER,
        inclusive=True,
    ).drop(BLOCK)


def gap_report(diffs: DataFrame, span: int = BLOCK_SPAN) -> DataFrame:
    """One row per gap: the expected id, the id found and how many are missing."""
    seen = _with_last_seen(diffs, span)
    expected = F.col("_last_seen") + 1
    return seen.where(
        _fresh() & F.col("_last_seen").isNotNull() & (F.col("first_update_id") > expected)
    ).select(
        *KEYS,
        "kafka_partition",
        "kafka_offset",
        expected.alias("expected_update_id"),
        "first_update_id",
        "last_update_id",
        (F.col("first_update_id") - expected).alias("missing_ids"),
    )
