"""Deterministic views of generic event and order tables as market-data inputs.

Each adapter is a projection (or a union of projections) of the whole table, so its output
grows with the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

AS_OF = "2024-01-31 00:00:00"
_ISO = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"
_LATER = 1_000_000_000  # offsets of re-delivered rows start here


def _table(spark: SparkSession, sf_dir: str, name: str, time: str, stream: bool) -> DataFrame:
    path = f"{sf_dir}/{name}.parquet"
    if stream:
        schema = spark.read.parquet(path).schema  # of a fixed input file, not inferred from rows
        rows = spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)
    else:
        rows = spark.read.parquet(path)
    return rows.withColumn(time, F.col(time).cast("timestamp"))


def _events(spark: SparkSession, sf_dir: str, stream: bool = False) -> DataFrame:
    return _table(spark, sf_dir, "events", "ts", stream)


def _orders(spark: SparkSession, sf_dir: str, stream: bool = False) -> DataFrame:
    return _table(spark, sf_dir, "orders", "o_orderdate", stream)


def ticks_of(events: DataFrame) -> DataFrame:
    """Event rows (``ts`` a timestamp) as book tickers; works on batch and stream."""
    base = events.select(
        F.expr("concat('sim#', event_type, '#', event_id + 1)").alias("event_id"),
        F.lit("sim").alias("exchange"),
        F.col("event_type").alias("symbol"),
        F.col("ts").alias("exchange_event_ts"),
        F.expr("timestampadd(SECOND, cast(event_id % 45 as int), ts)").alias("ingest_ts"),
        F.expr("timestampadd(SECOND, cast(event_id % 45 as int), ts)").alias("processed_ts"),
        F.expr("event_id + 1").alias("last_update_id"),
        F.col("event_id").alias("first_update_id"),
        F.expr("100 + value").alias("best_bid_price"),
        F.expr("cast(get_json_object(props, '$.k') as double)").alias("best_bid_qty"),
        F.expr("100 + value + 0.01D * (1 + event_id % 5)").alias("best_ask_price"),
        F.expr("cast(1 + user_id % 10 as double)").alias("best_ask_qty"),
        F.expr("cast(user_id % 10 as int)").alias("kafka_partition"),
        F.col("event_id").alias("kafka_offset"),
    )
    return base.selectExpr(
        "event_id",
        "exchange",
        "symbol",
        "exchange_event_ts",
        "ingest_ts",
        "processed_ts",
        "last_update_id",
        "first_update_id",
        "best_bid_price",
        "best_bid_qty",
        "best_ask_price",
        "best_ask_qty",
        "best_ask_price - best_bid_price AS spread",
        "(best_bid_price + best_ask_price) / 2 AS mid_price",
        "best_bid_qty / (best_bid_qty + best_ask_qty) AS imbalance",
        "'ticks' AS kafka_topic",
        "kafka_partition",
        "kafka_offset",
    )


def book_ticker(spark: SparkSession, sf_dir: str, stream: bool = False) -> DataFrame:
    return ticks_of(_events(spark, sf_dir, stream))


def ticks_with_unknown_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tickers of which every eleventh has lost its topic position."""
    lost = F.expr("kafka_offset % 11 = 0")
    return (
        book_ticker(spark, sf_dir)
        .withColumn("kafka_partition", F.when(lost, F.lit(-1)).otherwise(F.col("kafka_partition")))
        .withColumn("kafka_offset", F.when(lost, F.lit(-1)).otherwise(F.col("kafka_offset")))
    )


_BIDS = """array(
    array(cast(100 - event_id % 7 as string), cast(if(event_id % 3 = 0, 0, 1 + user_id % 10) as string)),
    array(cast(100 - (event_id + 2) % 7 as string), cast(1 + event_id % 4 as string)))"""
_ASKS = """array(
    array(cast(101 + event_id % 6 as string), cast(if(event_id % 4 = 0, 0, 1 + user_id % 8) as string)),
    array(cast(101 + (event_id + 1) % 6 as string), cast(1 + event_id % 3 as string)))"""


def depth_diffs(spark: SparkSession, sf_dir: str, stream: bool = False) -> DataFrame:
    return _events(spark, sf_dir, stream).selectExpr(
        "concat('sim#', event_type, '#', event_id + 1) AS event_id",
        "'sim' AS exchange",
        "event_type AS symbol",
        "ts AS exchange_event_ts",
        "ts AS ingest_ts",
        "timestampadd(SECOND, cast(event_id % 45 as int), ts) AS processed_ts",
        "event_id + 1 AS first_update_id",
        "event_id + 1 AS last_update_id",
        f"{_BIDS} AS bids",
        f"{_ASKS} AS asks",
        "'raw' AS kafka_topic",
        "0 AS kafka_partition",
        "event_id AS kafka_offset",
    )


def quiet_diffs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The depth diffs dealt out to three hundred instruments of one topic partition."""
    rows = depth_diffs(spark, sf_dir)
    return rows.withColumn("symbol", F.expr("concat('Q', kafka_offset % 300)"))


def sequenced_diffs(spark: SparkSession, sf_dir: str, redelivered: bool = True, stream: bool = False) -> DataFrame:
    """Five instruments with ranged update ids, id gaps, and rows delivered twice.

    Row n of an instrument covers ids 10m .. 10m+9 with m = n + n div 37, so ids skip ahead at
    every 37th row; every 50th row starts 5 ids late.  Every tenth row arrives again later.
    """
    rows = _events(spark, sf_dir, stream).selectExpr(
        "*",
        "concat('S', event_id % 5) AS symbol",
        "event_id div 5 AS n",
        "10 * (event_id div 5 + event_id div 5 div 37) AS base",
    )
    first = rows.selectExpr("*", "event_id AS kafka_offset")
    again = rows.where("n % 10 = 0").selectExpr("*", f"event_id + {_LATER}L AS kafka_offset")
    arrivals = first.unionByName(again) if redelivered else first
    return arrivals.selectExpr(
        "concat('sim#', symbol, '#', base + 9) AS event_id",
        "'sim' AS exchange",
        "symbol",
        "ts AS exchange_event_ts",
        "ts AS ingest_ts",
        "ts AS processed_ts",
        "base + if(n % 50 = 0, 5, 0) AS first_update_id",
        "base + 9 AS last_update_id",
        f"{_BIDS} AS bids",
        f"{_ASKS} AS asks",
        "'raw' AS kafka_topic",
        "0 AS kafka_partition",
        "kafka_offset",
    )


def depth_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A full book image of each sequenced instrument after its first row of every day."""
    firsts = (
        _events(spark, sf_dir)
        .withColumn("symbol", F.expr("concat('S', event_id % 5)"))
        .groupBy("symbol", F.to_date("ts").alias("day"))
        .agg(F.min("event_id").alias("event_id"))
    )
    return firsts.selectExpr(
        "'sim' AS exchange",
        "symbol",
        "10 * (event_id div 5 + event_id div 5 div 37) + 9 AS last_update_id",
        """transform(sequence(0, 6), i -> array(cast(100 - i as string),
             cast(1 + (event_id + i) % 9 as string))) AS bids""",
        """transform(sequence(0, 6), i -> array(cast(101 + i as string),
             cast(1 + (event_id + 2 * i) % 9 as string))) AS asks""",
    )


def raw_payloads(spark: SparkSession, sf_dir: str, stream: bool = False) -> DataFrame:
    """JSON diff records: three time spellings, cut-off JSON, missing symbols, empty records."""
    diffs = depth_diffs(spark, sf_dir, stream)
    iso_event, iso_ingest = (
        F.date_format(c, _ISO) for c in ("exchange_event_ts", "ingest_ts")
    )
    n = F.col("kafka_offset")
    times = (
        F.when(
            n % 3 == 0,
            F.concat(F.lit('"exchange_event_ts":"'), iso_event, F.lit('","ingest_ts":"'), iso_ingest, F.lit('"')),
        )
        .when(
            n % 3 == 1,
            F.concat(
                F.lit('"exchange_event_ts":'),
                F.unix_millis("exchange_event_ts").cast("string"),
                F.lit(',"ingest_ts":'),
                F.unix_millis("ingest_ts").cast("string"),
            ),
        )
        .otherwise(
            F.concat(F.lit('"event_time":"'), iso_event, F.lit('","ingest_time":"'), iso_ingest, F.lit('"'))
        )
    )
    text = F.concat(
        F.lit('{"event_id":"'),
        F.col("event_id"),
        F.lit('","exchange":"sim",'),
        F.when(n % 103 == 0, F.lit("")).otherwise(F.concat(F.lit('"symbol":"'), F.col("symbol"), F.lit('",'))),
        times,
        F.lit(',"first_update_id":'),
        F.col("first_update_id").cast("string"),
        F.lit(',"last_update_id":'),
        F.col("last_update_id").cast("string"),
        F.lit(',"bids":'),
        F.to_json("bids"),
        F.lit(',"asks":'),
        F.to_json("asks"),
        F.lit("}"),
    )
    payload = (
        F.when(n % 107 == 0, F.lit(None))
        .when(n % 101 == 0, F.expr("substring(_text, 1, length(_text) - 1)"))
        .otherwise(F.col("_text"))
    )
    return diffs.withColumn("_text", text).select(
        payload.alias("payload"), "kafka_partition", "kafka_offset", "processed_ts"
    )


def wire_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exchange wire messages: other event types, missing ids and broken levels mixed in."""
    n = F.col("kafka_offset")
    diffs = depth_diffs(spark, sf_dir)
    text = F.concat(
        F.lit('{"e":"'),
        F.when(n % 97 == 0, F.lit("trade")).otherwise(F.lit("depthUpdate")),
        F.lit('","E":'),
        F.unix_millis("exchange_event_ts").cast("string"),
        F.lit(',"s":"'),
        F.upper("symbol"),
        F.lit('",'),
        F.when(n % 89 == 0, F.lit("")).otherwise(
            F.concat(F.lit('"U":'), F.col("first_update_id").cast("string"), F.lit(","))
        ),
        F.lit('"u":'),
        F.col("last_update_id").cast("string"),
        F.lit(',"b":'),
        F.when(n % 83 == 0, F.lit('[["100"]]')).otherwise(F.to_json("bids")),
        F.lit(',"a":'),
        F.to_json("asks"),
        F.lit("}"),
    )
    return diffs.select(text.alias("payload"), "kafka_partition", "kafka_offset", "processed_ts")


def topic_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of a ten-partition topic: ``key, value, kafka_partition, kafka_offset, record_ts``."""
    return _events(spark, sf_dir).selectExpr(
        "concat('sim#', event_type) AS key",
        "props AS value",
        "cast(user_id % 10 as int) AS kafka_partition",
        "event_id AS kafka_offset",
        "ts AS record_ts",
    )


def change_envelopes(spark: SparkSession, sf_dir: str, stream: bool = False) -> DataFrame:
    """Change records of fifty symbols, one per order, with a few rejects among them."""
    k = F.col("o_orderkey")
    symbol = F.expr("concat('SYM', o_custkey % 50)")
    status = F.expr("decode(o_orderstatus, 'F', 'TRADING', 'O', 'BREAK', 'HALT')")
    image = F.concat(
        F.lit('{"symbol":"'),
        symbol,
        F.lit('","exchange":"sim","status":"'),
        status,
        F.lit('","base_asset":"'),
        symbol,
        F.lit('","quote_asset":"USD","lot_size_min":0.5,"lot_size_step":0.25,"tick_size":'),
        F.col("o_totalprice").cast("string"),
        F.lit(',"created_at":'),
        F.unix_millis("o_orderdate").cast("string"),
        F.lit(',"updated_at":'),
        (F.unix_millis("o_orderdate") + k).cast("string"),
        F.lit("}"),
    )
    op = F.expr(
        """case when o_orderkey % 211 = 0 then 'x' when o_orderkey % 7 = 0 then 'd'
                when o_orderkey % 5 = 0 then 'r' when o_orderkey % 3 = 0 then 'c' else 'u' end"""
    )
    nothing = k % 223 == 0
    null = F.lit("null")
    before = F.when(nothing | F.col("op").isin("r", "c"), null).otherwise(F.col("image"))
    after = F.when(nothing | (F.col("op") == "d"), null).otherwise(F.col("image"))
    text = F.concat(
        F.lit('{"before":'),
        before,
        F.lit(',"after":'),
        after,
        F.lit(',"source":{"lsn":'),
        k.cast("string"),
        F.lit(',"ts_ms":'),
        F.unix_millis("o_orderdate").cast("string"),
        F.lit(',"txId":'),
        (k % 1000).cast("string"),
        F.lit('},"op":"'),
        F.col("op"),
        F.lit('","ts_ms":'),
        (F.unix_millis("o_orderdate") + 5).cast("string"),
        F.lit("}"),
    )
    payload = F.when(k % 227 == 0, F.expr("substring(_text, 1, length(_text) - 2)")).otherwise(F.col("_text"))
    return (
        _orders(spark, sf_dir, stream)
        .withColumn("image", image)
        .withColumn("op", op)
        .withColumn("_text", text)
        .select(payload.alias("payload"), F.lit(0).alias("kafka_partition"), k.alias("kafka_offset"))
    )


def keyed_envelopes(spark: SparkSession, sf_dir: str, stream: bool = False) -> DataFrame:
    """The change records as a source without full old images sends them, every ninth delivered twice.

    Updates have no old image, deletions only the key.
    """
    rows = change_envelopes(spark, sf_dir, stream)
    old = r'"before":\{"symbol":"([^"]*)"[^}]*\}'
    key_only = F.regexp_replace("payload", old, '"before":{"symbol":"$1"}')
    without = F.regexp_replace("payload", old, '"before":null')
    rows = rows.withColumn("payload", F.when(F.col("payload").contains('"op":"d"'), key_only).otherwise(without))
    again = rows.where("kafka_offset % 9 = 0").withColumn("kafka_offset", F.col("kafka_offset") + _LATER)
    return rows.unionByName(again)
