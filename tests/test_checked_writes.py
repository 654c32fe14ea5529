"""Rules counted while a table is written, typed streams, and marts whose "now" moves."""

from __future__ import annotations

import time

from helpers import at, random_diffs, tick, ticks
from pyspark.sql import functions as F
from pyspark.sql import types as T
from test_writes_streams import _payload, _put, _rows, _stream

from tidebook.operators import quality
from tidebook.plans import marts
from tidebook.schemas import RAW_RECORD
from tidebook.sinks import tables
from tidebook.streaming import jobs

RULES = [
    quality.Rule("not_null", "lineage"),
    quality.Rule("between", "mid_price", low=101, high=102),
    quality.Rule("accepted_values", "symbol", values=["a"]),
    quality.Rule("row_count", low=100),
    quality.Rule("unique", "last_update_id"),
]


def _sample(spark):
    df = ticks(spark, [tick(s, 30 * i, 100.0 + i, u=i) for s in "ab" for i in range(5)])
    return df.withColumn("lineage", F.when(F.col("last_update_id") > 1, F.col("symbol")))


def test_observed_rules_equal_a_scan(spark, folder):
    df = _sample(spark)
    stored, report = quality.write_checked(df, f"{folder}/t", "t", RULES)
    assert _rows(stored) == _rows(df)
    assert _rows(report) == _rows(quality.check(df, "t", RULES))
    assert [r["failures"] for r in report.where("rule = 'not_null'").collect()] == [4]
    empty, report = quality.write_checked(df.limit(0), f"{folder}/e", "e", RULES)
    assert empty.isEmpty() and _rows(report) == _rows(quality.check(df.limit(0), "e", RULES))


def test_row_rules_cost_no_scan_besides_the_write(spark, folder):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def counted(x):
        seen.add(1)
        return x

    df = _sample(spark).withColumn("last_update_id", counted.asNondeterministic()("last_update_id"))
    quality.write_checked(df, f"{folder}/t", "t", RULES)
    assert seen.value == 10


def test_typed_stream_keeps_each_event_once(spark, folder):
    """Second deliveries come in the same micro-batch and in later ones."""
    schema = T.StructType([*RAW_RECORD.fields, T.StructField("processed_ts", T.TimestampType())])
    rows = random_diffs(7, n=30, late=False)
    records = {(_payload(r), 0, r[12], r[5]) for r in rows}
    events = {tuple(r[1:3]) + (r[7],) for r in rows}
    for n in range(3):
        _put(spark.createDataFrame(sorted(records) * 2, schema), f"{folder}/in", n)
    raw = _stream(spark, f"{folder}/in", schema)
    jobs.start_diffs_job(raw, f"{folder}/t", f"{folder}/state", "30 days", available_now=True).awaitTermination()
    stored = spark.read.parquet(f"{folder}/t")
    assert stored.count() == stored.select("event_id").distinct().count() == len(events)
    # A restart finds nothing new.
    raw = _stream(spark, f"{folder}/in", schema)
    jobs.start_diffs_job(raw, f"{folder}/t", f"{folder}/state", "30 days", available_now=True).awaitTermination()
    assert spark.read.parquet(f"{folder}/t").count() == len(events)


def test_views_follow_the_clock(spark):
    df = ticks(spark, [tick("a", 0, 100.0)])
    tables.as_view(marts.exchange_health(df), "health_now")
    tables.as_view(marts.liquidity(df), "liquidity_now")
    ages = []
    for _ in range(2):
        row = spark.sql("SELECT h.staleness_seconds a, l.staleness_seconds b FROM health_now h JOIN liquidity_now l USING (symbol)").first()
        ages.append((row.a, row.b))
        time.sleep(1.2)
    assert ages[0][0] == ages[0][1] and ages[1][0] > ages[0][0] > 0
    assert marts.exchange_health(df, at(61)).first()["freshness_status"] == "WARN"
