"""Data-quality rules evaluated in one pass per table."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidebook.functions.clock import as_of_column, seconds_between
from tidebook.functions.market import FRESHNESS, SIGNALS
from tidebook.sources.tables import recent

# The rule set of the data model.
STATUSES = ["TRADING", "BREAK", "END_OF_DAY"]
SAMPLE_MINUTES = 10
REQUIRED = ["exchange", "symbol", "exchange_event_ts"]
PRICE_BOUNDS = {"best_bid_price": (0, None), "best_ask_price": (0, None)}
NOT_NULL = {
    "stg_book_ticker": [
        "event_id",
        "exchange",
        "symbol",
        "exchange_event_ts",
        "ingest_ts",
        "best_bid_price",
        "best_ask_price",
        "spread",
        "mid_price",
        "imbalance",
    ],
    "stg_ohlcv_1m": [
        "exchange",
        "symbol",
        "window_start",
        "window_end",
        "open_price",
        "high_price",
        "low_price",
        "close_price",
        "tick_count",
    ],
    "stg_symbol_config": ["symbol", "exchange", "status", "base_asset", "quote_asset"],
    "int_spread_metrics": ["exchange", "symbol", "latest_ts", "spread", "spread_bps"],
    "int_order_book_imbalance": ["exchange", "symbol", "imbalance", "market_signal"],
    "int_freshness_status": ["exchange", "symbol", "staleness_seconds", "freshness_status"],
    "mart_ohlcv": [
        "exchange",
        "symbol",
        "window_start",
        "window_end",
        "open_price",
        "high_price",
        "low_price",
        "close_price",
        "tick_count",
    ],
    "mart_liquidity": [
        "exchange",
        "symbol",
        "latest_ts",
        "spread_bps",
        "imbalance",
        "market_signal",
        "freshness_status",
    ],
    "mart_exchange_health": [
        "exchange",
        "symbol",
        "staleness_seconds",
        "freshness_status",
        "health_score",
    ],
}
ACCEPTED = {
    "stg_symbol_config": {"status": STATUSES},
    "int_order_book_imbalance": {"market_signal": SIGNALS},
    "int_freshness_status": {"freshness_status": FRESHNESS},
    "mart_liquidity": {"market_signal": SIGNALS, "freshness_status": FRESHNESS},
    "mart_exchange_health": {"freshness_status": FRESHNESS},
}
UNIQUE = {"stg_symbol_config": ["symbol"]}
REPORT = "table_name string, rule string, column_name string, checked_rows long, failures long, passed boolean"


@dataclass(frozen=True)
class Rule:
    """``kind`` is one of not_null, accepted_values, between, unique, row_count."""

    kind: str
    column: str | None = None
    values: list = field(default_factory=list)
    low: float | None = None
    high: float | None = None


def model_rules(table: str, statuses: list[str] | None = None) -> list[Rule]:
    accepted = dict(ACCEPTED.get(table, {}))
    if statuses is not None and "status" in accepted:
        accepted["status"] = statuses
    return (
        [Rule("not_null", c) for c in NOT_NULL.get(table, [])]
        + [Rule("accepted_values", c, values=v) for c, v in accepted.items()]
        + [Rule("unique", c) for c in UNIQUE.get(table, [])]
    )


def _failures(rule: Rule) -> Column:
    column = F.col(rule.column) if rule.column else None
    if rule.kind == "not_null":
        return F.count_if(column.isNull())
    if rule.kind == "accepted_values":
        return F.count_if(~column.isin(rule.values))
    if rule.kind == "between":
        outside = F.lit(False)
        if rule.low is not None:
            outside = outside | (column < rule.low)
        if rule.high is not None:
            outside = outside | (column > rule.high)
        return F.count_if(outside)
    if rule.kind == "row_count":
        rows = F.count(F.lit(1))
        too_few = F.lit(False) if rule.low is None else rows < int(rule.low)
        too_many = F.lit(False) if rule.high is None else rows > int(rule.high)
        return (too_few | too_many).cast("long")
    raise ValueError(f"unknown rule kind {rule.kind}")


def check(df: DataFrame, table: str, rules: list[Rule]) -> DataFrame:
    """``table_name, rule, column_name, checked_rows, failures, passed`` per rule.

    All row rules share one aggregation; a uniqueness rule adds one group-by on its column
    and counts the values that occur more than once.
    """
    reports = []
    row_rules = [r for r in rules if r.kind != "unique"]
    if row_rules:
        counted = df.agg(
            F.count(F.lit(1)).alias("_rows"), *[_failures(r).alias(f"_f{i}") for i, r in enumerate(row_rules)]
        )
        results = F.array(
            *[
                F.struct(
                    F.lit(r.kind).alias("rule"),
                    F.lit(r.column or "").alias("column_name"),
                    F.col("_rows").alias("checked_rows"),
                    F.col(f"_f{i}").alias("failures"),
                )
                for i, r in enumerate(row_rules)
            ]
        )
        reports.append(counted.select(F.inline(results)))
    for rule in (r for r in rules if r.kind == "unique"):
        per_value = df.where(F.col(rule.column).isNotNull()).groupBy(rule.column).agg(F.count(F.lit(1)).alias("_n"))
        reports.append(
            per_value.agg(
                F.coalesce(F.sum("_n"), F.lit(0)).alias("checked_rows"),
                F.count_if(F.col("_n") > 1).alias("failures"),
            ).select(
                F.lit("unique").alias("rule"), F.lit(rule.column).alias("column_name"), "checked_rows", "failures"
            )
        )
    return reduce(DataFrame.unionByName, reports).select(
        F.lit(table).alias("table_name"),
        "rule",
        "column_name",
        "checked_rows",
        "failures",
        (F.col("failures") == 0).alias("passed"),
    )


def observed(df: DataFrame, rules: list[Rule]) -> tuple[DataFrame, Observation]:
    """``df`` with the row rules counted while it is written or otherwise run once: they cost no scan.

    A uniqueness rule needs a group-by and is left to ``check`` on the stored column.
    """
    found = Observation()
    row_rules = [r for r in rules if r.kind != "unique"]
    counts = [_failures(r).alias(f"f{i}") for i, r in enumerate(row_rules)]
    return df.observe(found, F.count(F.lit(1)).alias("checked_rows"), *counts), found


def observed_report(spark: SparkSession, found: Observation, table: str, rules: list[Rule]) -> DataFrame:
    """The report of ``check`` from the metrics of a finished run; one row a rule."""
    counts = found.get
    row_rules = [r for r in rules if r.kind != "unique"]
    rows = [
        (table, r.kind, r.column or "", counts["checked_rows"], counts[f"f{i}"], counts[f"f{i}"] == 0)
        for i, r in enumerate(row_rules)
    ]
    return spark.createDataFrame(rows, REPORT)


def write_checked(df: DataFrame, path: str, table: str, rules: list[Rule]) -> tuple[DataFrame, DataFrame]:
    """Store ``df``; returns the stored rows and the report of its rules.

    Row rules are counted by the write itself; only the columns of uniqueness rules are read again.
    """
    marked, found = observed(df, rules)
    marked.write.mode("overwrite").parquet(path)
    stored = df.sparkSession.read.schema(df.schema).parquet(path)
    report = observed_report(df.sparkSession, found, table, rules)
    unique = [r for r in rules if r.kind == "unique"]
    return stored, report.unionByName(check(stored, table, unique)) if unique else report


def check_recent(
    df: DataFrame,
    table: str,
    time_column: str,
    as_of=None,
    minutes: int = SAMPLE_MINUTES,
    limit: int | None = None,
) -> DataFrame:
    """Expectations on the recent window: required columns, price bounds, and that there is data.

    The whole window is checked; ``limit`` gives the sampled form.
    """
    required = [time_column if c == "exchange_event_ts" else c for c in REQUIRED]
    rules = [Rule("not_null", c) for c in required if c in df.columns]
    rules += [
        Rule("between", c, low=low, high=high) for c, (low, high) in PRICE_BOUNDS.items() if c in df.columns
    ]
    rules.append(Rule("row_count", low=1))
    report = check(recent(df, minutes, as_of, time_column, limit), table, rules)
    return report.withColumn(
        "rule", F.when(F.col("rule") == "row_count", F.lit("no_recent_data")).otherwise(F.col("rule"))
    )


def source_freshness(
    tables: dict[str, tuple[DataFrame, str]], as_of=None, warn_minutes: int = 2, error_minutes: int = 5
) -> DataFrame:
    """Load age per table: pass, warn beyond 2 minutes, error beyond 5 (or when empty)."""
    now = as_of_column(as_of)
    loaded = F.col("max_loaded_at")
    error = loaded.isNull() | (loaded < now - F.make_dt_interval(mins=F.lit(error_minutes)))
    warn = loaded < now - F.make_dt_interval(mins=F.lit(warn_minutes))
    reports = [
        df.agg(F.max(column).alias("max_loaded_at")).select(
            F.lit(name).alias("table_name"),
            "max_loaded_at",
            seconds_between(loaded, now).alias("age_seconds"),
            F.when(error, F.lit("error")).when(warn, F.lit("warn")).otherwise(F.lit("pass")).alias("status"),
        )
        for name, (df, column) in tables.items()
    ]
    return reduce(DataFrame.unionByName, reports)


def failed(report: DataFrame) -> DataFrame:
    return report.where(~F.col("passed"))
