"""Time the headline queries and print one JSON line.

Environment: ``BENCH_SF_DIR`` (default /root/testdata/sf0.1), ``BENCH_CPUS`` (default 8).
Each query is computed in full into a sink that discards rows: once to warm up, once timed.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "ohlcv_bars",
    "ohlcv_minute_bars",
    "ohlcv_backfill",
    "bar_rollup",
    "spread_metrics",
    "mart_liquidity",
    "exchange_health",
    "recent_bars",
    "historical_bars",
    "gauge_feed",
    "parse_events",
    "parse_wire",
    "monotone_dedup",
    "gap_report",
    "order_book_ticker",
    "snapshot_init",
    "cdc_bronze",
    "cdc_current_state",
    "offset_ranges",
    "replay_rows",
    "dq_report",
    "stream_ohlcv",
    "stream_ticker",
    "stream_cdc_state",
    "overwrite_idempotent",
    "compaction",
]


def main() -> None:
    from tidebook.checks.queries import QUERIES
    from tidebook.session import build_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        {
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "12g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds = {}
    for name in HEADLINE:
        run(name)
        seconds[name] = round(run(name), 3)
    diffs = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rsplit("sf", 1)[-1],
                "stream_diffs_per_sec": round(diffs / seconds["stream_ticker"], 1),
                "batch_diffs_per_sec": round(diffs / seconds["order_book_ticker"], 1),
            }
        )
    )


if __name__ == "__main__":
    main()
