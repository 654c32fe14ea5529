"""SQL twins of the queries, for an independent engine over the same tables."""

from __future__ import annotations

AS_OF = "TIMESTAMP '2024-01-31 00:00:00'"

TICKS = """
ev AS (
  SELECT *, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events),
q AS (
  SELECT *, 100 + value AS bid, 100 + value + CAST(0.01 AS DOUBLE) * (1 + event_id % 5) AS ask,
         CAST(1 + user_id % 10 AS DOUBLE) AS ask_qty
  FROM ev),
ticks AS (
  SELECT 'sim#' || event_type || '#' || (event_id + 1) AS event_id, 'sim' AS exchange, event_type AS symbol,
         ts AS exchange_event_ts, ts + to_seconds(event_id % 45) AS ingest_ts,
         ts + to_seconds(event_id % 45) AS processed_ts,
         event_id + 1 AS last_update_id, event_id AS first_update_id,
         bid AS best_bid_price, k AS best_bid_qty, ask AS best_ask_price, ask_qty AS best_ask_qty,
         ask - bid AS spread, (bid + ask) / 2 AS mid_price, k / (k + ask_qty) AS imbalance,
         'ticks' AS kafka_topic, CAST(user_id % 10 AS INTEGER) AS kafka_partition, q.event_id AS kafka_offset
  FROM q)"""

STG_TICK = """event_id, exchange, symbol, exchange_event_ts, ingest_ts, best_bid_price, best_bid_qty,
  best_ask_price, best_ask_qty, spread, mid_price, imbalance, kafka_topic, kafka_partition, kafka_offset"""

BAR = """exchange, symbol, window_start, window_end, open_price, high_price, low_price, close_price,
  round(volume, 6) AS volume, round(vwap, 6) AS vwap, tick_count, first_ts, last_ts"""


def bars(interval: str, vwap: str = "tick", where: str = "TRUE", name: str = "bars") -> str:
    fallback = {"tick": "avg(mid_price)", "close": "arg_max(mid_price, (exchange_event_ts, last_update_id))"}
    weighted = f"""CASE WHEN sum(best_bid_qty) > 0
         THEN sum(mid_price * best_bid_qty) / sum(best_bid_qty) ELSE {fallback.get(vwap, "0")} END"""
    return f"""
{name} AS (
  SELECT exchange, symbol, time_bucket(INTERVAL '{interval}', exchange_event_ts) AS window_start,
         time_bucket(INTERVAL '{interval}', exchange_event_ts) + INTERVAL '{interval}' AS window_end,
         arg_min(mid_price, (exchange_event_ts, last_update_id)) AS open_price, max(mid_price) AS high_price,
         min(mid_price) AS low_price, arg_max(mid_price, (exchange_event_ts, last_update_id)) AS close_price,
         sum(best_bid_qty) AS volume, {"avg(mid_price)" if vwap == "avg" else weighted} AS vwap,
         count(*) AS tick_count, min(exchange_event_ts) AS first_ts, max(exchange_event_ts) AS last_ts
  FROM ticks WHERE mid_price IS NOT NULL AND {where}
  GROUP BY ALL)"""


LATEST = """
latest AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY exchange, symbol
             ORDER BY exchange_event_ts DESC, kafka_partition DESC, kafka_offset DESC) AS rn FROM ticks)
  WHERE rn = 1)"""

BPS = "round(spread / nullif(mid_price, 0) * 10000, 4)"
SIGNAL = """CASE WHEN imbalance > 0.6 THEN 'BUY_PRESSURE' WHEN imbalance < 0.4 THEN 'SELL_PRESSURE'
  ELSE 'NEUTRAL' END"""


def fresh(age: str, cut: tuple[int, int] = (1000, 2000)) -> str:
    return f"CASE WHEN {age} <= {cut[0]} THEN 'FRESH' WHEN {age} <= {cut[1]} THEN 'WARN' ELSE 'STALE' END"


def _age(column: str) -> str:
    # complete seconds elapsed
    return f"date_sub('second', {column}, {AS_OF})"


HEALTH = f"""
fresh0 AS (
  SELECT exchange, symbol, max(exchange_event_ts) AS latest_event_ts, max(ingest_ts) AS latest_ingest_ts,
         {_age("max(exchange_event_ts)")} AS staleness_seconds
  FROM ticks GROUP BY exchange, symbol),
freshness AS (SELECT *, {fresh("staleness_seconds")} AS freshness_status FROM fresh0),
health AS (
  SELECT *, CAST(CASE WHEN staleness_seconds <= 1000 THEN 1.0 WHEN staleness_seconds <= 2000 THEN 0.5 ELSE 0.0 END
         AS DOUBLE) AS health_score FROM freshness)"""

LIQUIDITY = f"""
liquidity AS (
  SELECT l.exchange, l.symbol, l.exchange_event_ts AS latest_ts, best_bid_price, best_ask_price, spread, mid_price,
         {BPS} AS spread_bps, best_bid_qty, best_ask_qty, imbalance, {SIGNAL} AS market_signal,
         f.staleness_seconds, f.freshness_status
  FROM latest l LEFT JOIN freshness f ON l.exchange = f.exchange AND l.symbol = f.symbol)"""

LEVELS = """100 - event_id % 7 AS b1, CASE WHEN event_id % 3 = 0 THEN 0 ELSE 1 + user_id % 10 END AS bq1,
         100 - (event_id + 2) % 7 AS b2, 1 + event_id % 4 AS bq2,
         101 + event_id % 6 AS a1, CASE WHEN event_id % 4 = 0 THEN 0 ELSE 1 + user_id % 8 END AS aq1,
         101 + (event_id + 1) % 6 AS a2, 1 + event_id % 3 AS aq2"""

DIFFS = f"""
diffs AS (
  SELECT event_id AS n, 'sim#' || event_type || '#' || (event_id + 1) AS event_id, 'sim' AS exchange,
         event_type AS symbol, ts AS exchange_event_ts, ts AS ingest_ts,
         ts + to_seconds(event_id % 45) AS processed_ts, event_id % 45 AS lag_s,
         event_id + 1 AS first_update_id, event_id + 1 AS last_update_id, {LEVELS},
         'raw' AS kafka_topic, 0 AS kafka_partition, event_id AS kafka_offset
  FROM events)"""

SEQ = f"""
seq0 AS (
  SELECT *, 'S' || (event_id % 5) AS symbol, event_id // 5 AS n,
         10 * (event_id // 5 + event_id // 5 // 37) AS base, {LEVELS} FROM events),
seq_first AS (SELECT *, event_id AS kafka_offset FROM seq0),
seq_all AS (
  SELECT * FROM seq_first UNION ALL SELECT *, event_id + 1000000000 AS kafka_offset FROM seq0 WHERE n % 10 = 0)"""


def seq(source: str, name: str = "diffs") -> str:
    return f"""
{name} AS (
  SELECT 'sim#' || symbol || '#' || (base + 9) AS event_id, 'sim' AS exchange, symbol, ts AS exchange_event_ts,
         ts AS ingest_ts, ts AS processed_ts,
         base + CASE WHEN n % 50 = 0 THEN 5 ELSE 0 END AS first_update_id, base + 9 AS last_update_id,
         b1, bq1, b2, bq2, a1, aq1, a2, aq2, 'raw' AS kafka_topic, 0 AS kafka_partition, kafka_offset
  FROM {source})"""


SEEN = """
seen AS (
  SELECT *, max(last_update_id) OVER (PARTITION BY exchange, symbol ORDER BY kafka_offset
         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS last_seen_id FROM diffs),
flags AS (
  SELECT *, last_seen_id IS NOT NULL AND last_update_id <= last_seen_id AS is_stale,
         last_seen_id IS NOT NULL AND last_update_id > last_seen_id AND first_update_id > last_seen_id + 1 AS is_gap
  FROM seen)"""

TICKER = """event_id, exchange, symbol, exchange_event_ts, ingest_ts, processed_ts, last_update_id, first_update_id,
  best_bid_price, best_bid_qty, best_ask_price, best_ask_qty, best_ask_price - best_bid_price AS spread,
  (best_bid_price + best_ask_price) / 2 AS mid_price,
  round(CASE WHEN bid_volume + ask_volume > 0 THEN bid_volume / (bid_volume + ask_volume) ELSE 0.5 END, 6) AS imbalance,
  kafka_topic, kafka_partition, kafka_offset"""


def lifetimes(key: str, extra_levels: str = "") -> str:
    """Books from level lifetimes: a level holds from its write to the next write of its price.

    ``usable`` are the applied diffs, ordered within ``key`` by ``last_update_id``.
    """
    return f"""
writes AS (
  SELECT {key}, last_update_id AS u, 'b' AS side, CAST(b1 AS VARCHAR) AS px, CAST(bq1 AS DOUBLE) AS qty FROM usable
  UNION ALL SELECT {key}, last_update_id, 'b', CAST(b2 AS VARCHAR), CAST(bq2 AS DOUBLE) FROM usable
  UNION ALL SELECT {key}, last_update_id, 'a', CAST(a1 AS VARCHAR), CAST(aq1 AS DOUBLE) FROM usable
  UNION ALL SELECT {key}, last_update_id, 'a', CAST(a2 AS VARCHAR), CAST(aq2 AS DOUBLE) FROM usable
  {extra_levels}),
life AS (SELECT *, lead(u) OVER (PARTITION BY {key}, side, px ORDER BY u) AS until FROM writes),
held AS (
  SELECT {", ".join("e." + c.strip() for c in key.split(","))}, e.last_update_id, l.side,
         CAST(l.px AS DOUBLE) AS price, l.qty,
         row_number() OVER (PARTITION BY {", ".join("e." + c.strip() for c in key.split(","))}, e.last_update_id, l.side
           ORDER BY CASE WHEN l.side = 'b' THEN -CAST(l.px AS DOUBLE) ELSE CAST(l.px AS DOUBLE) END) AS rk
  FROM usable e JOIN life l
    ON {" AND ".join(f"e.{c.strip()} = l.{c.strip()}" for c in key.split(","))}
   AND l.u <= e.last_update_id AND (l.until IS NULL OR e.last_update_id < l.until) AND l.qty <> 0),
quotes AS (
  SELECT {key}, last_update_id,
         max(CASE WHEN side = 'b' AND rk = 1 THEN price END) AS best_bid_price,
         max(CASE WHEN side = 'b' AND rk = 1 THEN qty END) AS best_bid_qty,
         max(CASE WHEN side = 'a' AND rk = 1 THEN price END) AS best_ask_price,
         max(CASE WHEN side = 'a' AND rk = 1 THEN qty END) AS best_ask_qty,
         coalesce(sum(CASE WHEN side = 'b' AND rk <= 5 THEN qty END), 0) AS bid_volume,
         coalesce(sum(CASE WHEN side = 'a' AND rk <= 5 THEN qty END), 0) AS ask_volume
  FROM held GROUP BY ALL),
ticker AS (
  SELECT u.*, q.* EXCLUDE ({key}, last_update_id)
  FROM usable u JOIN quotes q USING ({key}, last_update_id)
  WHERE q.best_bid_price IS NOT NULL AND q.best_ask_price IS NOT NULL)"""


SNAPSHOTS = """
firsts AS (
  SELECT 'S' || (event_id % 5) AS symbol, min(event_id) AS event_id FROM events
  GROUP BY 'S' || (event_id % 5), CAST(ts AS DATE)),
snaps AS (
  SELECT symbol, event_id, 10 * (event_id // 5 + event_id // 5 // 37) + 9 AS last_update_id FROM firsts),
steps AS (SELECT CAST(unnest([0, 1, 2, 3, 4, 5, 6]) AS BIGINT) AS i),
images AS (
  SELECT symbol, last_update_id, i, 100 - i AS bid, 1 + (event_id + i) % 9 AS bid_qty,
         101 + i AS ask, 1 + (event_id + 2 * i) % 9 AS ask_qty
  FROM snaps, steps)"""

# Rows usable after a snapshot: none at or below its id, none from the first gap on.
USABLE = """
kept AS (SELECT * EXCLUDE (last_seen_id, is_stale, is_gap) FROM flags WHERE NOT is_stale),
marks AS (
  SELECT symbol, last_update_id AS id, first_update_id AS first_id, 0 AS snap FROM kept
  UNION ALL SELECT symbol, last_update_id, last_update_id, 1 FROM snaps),
chain AS (
  SELECT *, lag(id) OVER w AS prev,
         max(CASE WHEN snap = 1 THEN id END) OVER w AS snapshot_id
  FROM marks WINDOW w AS (PARTITION BY symbol ORDER BY id, snap)),
broken AS (
  SELECT symbol, snapshot_id, min(id) AS gap_at FROM chain
  WHERE snap = 0 AND prev IS NOT NULL AND first_id > prev + 1 AND id > snapshot_id
  GROUP BY symbol, snapshot_id),
usable AS (
  SELECT k.*, c.snapshot_id FROM kept k
  JOIN chain c ON c.symbol = k.symbol AND c.id = k.last_update_id AND c.snap = 0
  LEFT JOIN broken b ON b.symbol = c.symbol AND b.snapshot_id = c.snapshot_id
  WHERE c.snapshot_id IS NOT NULL AND (b.gap_at IS NULL OR c.id < b.gap_at))"""

SNAPSHOT_LEVELS = """
  UNION ALL SELECT symbol, last_update_id, last_update_id, 'b', CAST(bid AS VARCHAR), CAST(bid_qty AS DOUBLE) FROM images
  UNION ALL SELECT symbol, last_update_id, last_update_id, 'a', CAST(ask AS VARCHAR), CAST(ask_qty AS DOUBLE) FROM images"""

LEVEL_JSON = """'[["' || {0}1 || '","' || {0}q1 || '"],["' || {0}2 || '","' || {0}q2 || '"]]'"""
BIDS_JSON, ASKS_JSON = LEVEL_JSON.format("b"), LEVEL_JSON.format("a")
LEVEL_TEXT = """b1 || ',' || bq1 || ',' || b2 || ',' || bq2 AS bids, a1 || ',' || aq1 || ',' || a2 || ',' || aq2 AS asks"""
ISO = "strftime({}, '%Y-%m-%dT%H:%M:%S.%gZ')"

PAYLOADS = f"""
texts AS (
  SELECT *, '{{"event_id":"' || event_id || '","exchange":"sim",' ||
    CASE WHEN n % 103 = 0 THEN '' ELSE '"symbol":"' || symbol || '",' END ||
    CASE n % 3
      WHEN 0 THEN '"exchange_event_ts":"' || {ISO.format("exchange_event_ts")} || '","ingest_ts":"' || {ISO.format("ingest_ts")} || '"'
      WHEN 1 THEN '"exchange_event_ts":' || (epoch_us(exchange_event_ts) // 1000) || ',"ingest_ts":' || (epoch_us(ingest_ts) // 1000)
      ELSE '"event_time":"' || {ISO.format("exchange_event_ts")} || '","ingest_time":"' || {ISO.format("ingest_ts")} || '"' END ||
    ',"first_update_id":' || first_update_id || ',"last_update_id":' || last_update_id ||
    ',"bids":' || {BIDS_JSON} || ',"asks":' || {ASKS_JSON} || '}}' AS body
  FROM diffs),
raw AS (
  SELECT CASE WHEN n % 107 = 0 THEN NULL WHEN n % 101 = 0 THEN left(body, length(body) - 1) ELSE body END AS payload,
         kafka_partition, kafka_offset, processed_ts FROM texts),
judged AS (
  SELECT *, CASE WHEN payload IS NULL THEN 'tombstone' WHEN NOT json_valid(payload) THEN 'malformed_json'
      WHEN json_extract(payload, '$.symbol') IS NULL THEN 'missing_field' END AS error_type FROM raw),
good AS (
  SELECT j.* FROM (
    SELECT *, json_extract_string(payload, '$.exchange_event_ts') AS t1, json_extract_string(payload, '$.event_time') AS t2,
           json_extract_string(payload, '$.ingest_ts') AS i1, json_extract_string(payload, '$.ingest_time') AS i2
    FROM judged WHERE error_type IS NULL) j),
parsed AS (
  SELECT json_extract_string(payload, '$.event_id') AS event_id, json_extract_string(payload, '$.exchange') AS exchange,
    json_extract_string(payload, '$.symbol') AS symbol,
    CASE WHEN regexp_full_match(coalesce(t1, t2), '[0-9]+') THEN make_timestamp(CAST(coalesce(t1, t2) AS BIGINT) * 1000)
         ELSE strptime(coalesce(t1, t2), '%Y-%m-%dT%H:%M:%S.%gZ') END AS exchange_event_ts,
    CASE WHEN regexp_full_match(coalesce(i1, i2), '[0-9]+') THEN make_timestamp(CAST(coalesce(i1, i2) AS BIGINT) * 1000)
         ELSE strptime(coalesce(i1, i2), '%Y-%m-%dT%H:%M:%S.%gZ') END AS ingest_ts,
    processed_ts, CAST(json_extract_string(payload, '$.first_update_id') AS BIGINT) AS first_update_id,
    CAST(json_extract_string(payload, '$.last_update_id') AS BIGINT) AS last_update_id,
    json_extract_string(payload, '$.bids[0][0]') AS b1, json_extract_string(payload, '$.bids[0][1]') AS bq1,
    json_extract_string(payload, '$.bids[1][0]') AS b2, json_extract_string(payload, '$.bids[1][1]') AS bq2,
    json_extract_string(payload, '$.asks[0][0]') AS a1, json_extract_string(payload, '$.asks[0][1]') AS aq1,
    json_extract_string(payload, '$.asks[1][0]') AS a2, json_extract_string(payload, '$.asks[1][1]') AS aq2,
    'market.raw.orderbook' AS kafka_topic, kafka_partition, kafka_offset
  FROM good)"""

MESSAGE = """CASE error_type WHEN 'tombstone' THEN 'record has no value'
    WHEN 'malformed_json' THEN 'payload is not valid JSON of the expected shape'
    WHEN 'missing_field' THEN 'a required field is absent'
    WHEN 'late_event' THEN 'event lags processing time by more than the threshold' END"""

CDC = """
chg AS (
  SELECT o_orderkey AS k, 'SYM' || (o_custkey % 50) AS symbol,
    CASE o_orderstatus WHEN 'F' THEN 'TRADING' WHEN 'O' THEN 'BREAK' ELSE 'HALT' END AS status,
    o_totalprice AS tick_size, o_orderdate AS created_at, o_orderdate + to_milliseconds(o_orderkey) AS updated_at,
    CASE WHEN o_orderkey % 211 = 0 THEN 'x' WHEN o_orderkey % 7 = 0 THEN 'd' WHEN o_orderkey % 5 = 0 THEN 'r'
         WHEN o_orderkey % 3 = 0 THEN 'c' ELSE 'u' END AS op,
    CASE WHEN o_orderkey % 227 = 0 THEN 'malformed_json' WHEN o_orderkey % 211 = 0 THEN 'unknown_op'
         WHEN o_orderkey % 223 = 0 THEN 'empty_payload' END AS error_type
  FROM orders),
audit AS (SELECT * FROM chg WHERE error_type IS NULL),
last_change AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY k DESC) AS rn FROM audit) WHERE rn = 1),
config AS (
  SELECT symbol, 'sim' AS exchange, status, symbol AS base_asset, 'USD' AS quote_asset,
         CAST(0.5 AS DOUBLE) AS lot_size_min, CAST(0.25 AS DOUBLE) AS lot_size_step, tick_size, created_at, updated_at
  FROM last_change WHERE op <> 'd')"""

AUDIT = f"""SELECT op, symbol, k AS source_lsn, (epoch_us(created_at) // 1000) AS source_ts_ms, k % 1000 AS source_tx_id,
  (epoch_us(created_at) // 1000) + 5 AS debezium_ts_ms, 'postgres.public.symbol_config' AS kafka_topic, 0 AS kafka_partition,
  k AS kafka_offset, {AS_OF} AS ingest_ts, CASE WHEN op IN ('r', 'c') THEN NULL ELSE status END AS before_status,
  CASE WHEN op = 'd' THEN NULL ELSE tick_size END AS after_tick_size FROM audit"""

RECORDS = """
records AS (
  SELECT 'sim#' || event_type AS key, props AS value, CAST(user_id % 10 AS INTEGER) AS kafka_partition,
         event_id AS kafka_offset, ts AS record_ts, event_type AS symbol FROM events),
span AS (SELECT TIMESTAMP '2024-01-10 00:00:00' AS lo, TIMESTAMP '2024-01-12 06:00:00' AS hi)"""


def ranges(where: str = "TRUE") -> str:
    return f"""
ranges AS (
  SELECT kafka_partition, min(kafka_offset) AS start_offset, max(kafka_offset) + 1 AS end_offset
  FROM records, span WHERE record_ts >= lo AND record_ts < hi AND kafka_offset % 11 <> 0 AND {where}
  GROUP BY kafka_partition)"""


def time_ranges(lo: str, hi: str) -> str:
    return f"""
time_ranges AS (
  SELECT * FROM (
    SELECT kafka_partition, min(kafka_offset) FILTER (WHERE record_ts >= TIMESTAMP '{lo}') AS start_offset,
           coalesce(min(kafka_offset) FILTER (WHERE record_ts >= TIMESTAMP '{hi}'), 9223372036854775807) AS end_offset
    FROM records GROUP BY kafka_partition)
  WHERE start_offset < end_offset)"""


IN_RANGE = """r.kafka_partition = g.kafka_partition AND r.kafka_offset >= g.start_offset
  AND r.kafka_offset < g.end_offset"""
RECORD = "r.key, r.value, r.kafka_partition, r.kafka_offset, r.record_ts"


def _rule(table: str, rule: str, column: str, failing: str, rows: str = "count(*)") -> str:
    return f"""SELECT '{table}' AS table_name, '{rule}' AS rule, '{column}' AS column_name,
      CAST({rows} AS BIGINT) AS checked_rows, CAST({failing} AS BIGINT) AS failures FROM m_{table}"""


def _dq_report() -> str:
    from tidebook.operators.quality import ACCEPTED, NOT_NULL, UNIQUE

    rules = []
    for table, columns in NOT_NULL.items():
        rules += [_rule(table, "not_null", c, f"count(*) FILTER (WHERE {c} IS NULL)") for c in columns]
    for table, accepted in ACCEPTED.items():
        for column, values in accepted.items():
            listed = ", ".join(f"'{v}'" for v in values)
            rules.append(
                _rule(table, "accepted_values", column, f"count(*) FILTER (WHERE {column} NOT IN ({listed}))")
            )
    for table, columns in UNIQUE.items():
        rules += [_rule(table, "unique", c, f"count({c}) - count(DISTINCT {c})", f"count({c})") for c in columns]
    body = "\nUNION ALL ".join(rules)
    return f"""WITH {TICKS}, {LATEST}, {HEALTH}, {LIQUIDITY}, {bars("1 hour")}, {CDC},
m_stg_book_ticker AS (SELECT * FROM ticks), m_stg_ohlcv_1m AS (SELECT * FROM bars),
m_stg_symbol_config AS (SELECT * FROM config), m_mart_ohlcv AS (SELECT * FROM bars),
m_int_spread_metrics AS (SELECT * FROM liquidity), m_int_order_book_imbalance AS (SELECT * FROM liquidity),
m_int_freshness_status AS (SELECT * FROM freshness), m_mart_liquidity AS (SELECT * FROM liquidity),
m_mart_exchange_health AS (SELECT * FROM health)
SELECT *, failures = 0 AS passed FROM ({body})"""


def _checks(table: str, source: str, rules: list[tuple[str, str, str, str]]) -> str:
    return "\nUNION ALL ".join(
        f"""SELECT '{table}' AS table_name, '{rule}' AS rule, '{column}' AS column_name,
      CAST({rows} AS BIGINT) AS checked_rows, CAST({failing} AS BIGINT) AS failures FROM {source}"""
        for rule, column, failing, rows in rules
    )


def _null_rule(column: str) -> tuple[str, str, str, str]:
    return "not_null", column, f"count(*) FILTER (WHERE {column} IS NULL)", "count(*)"


def _low_rule(column: str) -> tuple[str, str, str, str]:
    return "between", column, f"count(*) FILTER (WHERE {column} < 0)", "count(*)"


_EMPTY = ("no_recent_data", "", "CASE WHEN count(*) < 1 THEN 1 ELSE 0 END", "count(*)")

COUNTS_BELOW = "count(*) FILTER (WHERE {0})"

HOUR_BAR = f"WITH {TICKS}, {bars('1 hour')}"
MINUTE_BAR = f"WITH {TICKS}, {bars('1 minute')}"
MART = f"WITH {TICKS}, {LATEST}, {HEALTH}, {LIQUIDITY}"
GAUGE = "SELECT lower(symbol) AS symbol, exchange, '{1}' AS metric, CAST({0} AS DOUBLE) AS value FROM liquidity"
ON_TIME = "usable AS (SELECT * FROM diffs WHERE lag_s <= 30)"

ORACLES: dict[str, str] = {
    "ohlcv_bars": f"{HOUR_BAR} SELECT {BAR} FROM bars",
    "ohlcv_minute_bars": f"{MINUTE_BAR} SELECT {BAR} FROM bars",
    "ohlcv_close_fallback": f"WITH {TICKS}, {bars('1 minute', 'close')} SELECT {BAR} FROM bars",
    "ohlcv_backfill": f"""WITH {TICKS}, {bars("1 hour", "avg",
        "exchange_event_ts >= TIMESTAMP '2024-01-05' AND exchange_event_ts < TIMESTAMP '2024-01-20'")}
        SELECT {BAR}, CAST(window_start AS DATE) AS event_date FROM bars""",
    "bar_rollup": f"WITH {TICKS}, {bars('6 hours')} SELECT {BAR} FROM bars",
    "stg_book_ticker": f"WITH {TICKS} SELECT {STG_TICK} FROM ticks",
    "stg_ohlcv": f"{HOUR_BAR} SELECT {BAR} FROM bars",
    "stg_symbol_config": f"WITH {CDC} SELECT * FROM config",
    "mart_ohlcv": f"WITH {TICKS}, {bars('6 hours')} SELECT {BAR} FROM bars",
    "spread_metrics": f"""WITH {TICKS}, {LATEST} SELECT exchange, symbol, exchange_event_ts AS latest_ts, best_bid_price,
        best_ask_price, spread, mid_price, {BPS} AS spread_bps, best_bid_qty, best_ask_qty FROM latest""",
    "imbalance_signal": f"""WITH {TICKS}, {LATEST} SELECT exchange, symbol, exchange_event_ts AS latest_ts, best_bid_qty,
        best_ask_qty, imbalance, {SIGNAL} AS market_signal, imbalance * 2 - 1 AS signed_imbalance FROM latest""",
    "freshness_status": f"WITH {TICKS}, {HEALTH} SELECT * FROM freshness",
    "exchange_health": f"WITH {TICKS}, {HEALTH} SELECT * FROM health",
    "mart_liquidity": f"{MART} SELECT * FROM liquidity",
    "mart_liquidity_joined": f"{MART} SELECT * FROM liquidity",
    "sla_breaches": f"""WITH {TICKS} SELECT symbol, {_age("max(exchange_event_ts)")} AS staleness_s FROM ticks
        GROUP BY symbol HAVING {_age("max(exchange_event_ts)")} > 1500 ORDER BY staleness_s DESC""",
    "lag_rollup": f"""WITH {TICKS}, {HEALTH} SELECT count(*) FILTER (WHERE freshness_status = 'FRESH') AS healthy_count,
        count(*) AS total_count, {AS_OF} AS checked_at FROM health""",
    "symbol_counts": f"WITH {TICKS} SELECT symbol, count(*) AS ticks FROM ticks GROUP BY symbol ORDER BY ticks DESC",
    "silver_scan": f"""WITH {TICKS} SELECT kafka_partition, kafka_offset FROM ticks
        WHERE exchange_event_ts >= TIMESTAMP '2024-01-10' AND exchange_event_ts < TIMESTAMP '2024-01-12'
        AND symbol = 'view'""",
    "silver_scan_stored": f"""WITH {TICKS} SELECT kafka_partition, kafka_offset FROM ticks
        WHERE exchange_event_ts >= TIMESTAMP '2024-01-10' AND exchange_event_ts < TIMESTAMP '2024-01-12'
        AND symbol = 'view'""",
    "recent_rows": f"""WITH {TICKS} SELECT event_id, exchange_event_ts FROM ticks
        WHERE exchange_event_ts > {AS_OF} - INTERVAL '600 minutes'""",
    "liquidity_snapshot": f"{MART} SELECT * REPLACE (coalesce(imbalance, 0) AS imbalance) FROM liquidity",
    "spread_for_symbol": f"""{MART} SELECT exchange, symbol, latest_ts, best_bid_price, best_ask_price, spread, mid_price,
        spread_bps FROM liquidity WHERE upper(symbol) = 'VIEW'""",
    "liquidity_for_symbol": f"{MART} SELECT * FROM liquidity WHERE upper(symbol) = 'CLICK'",
    "recent_bars": f"""{MINUTE_BAR}, r AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY window_start DESC) AS rn
        FROM bars WHERE window_start >= {AS_OF} - INTERVAL '2 hours') SELECT {BAR} FROM r WHERE rn <= 60""",
    "recent_bars_ranked": f"""{HOUR_BAR}, r AS (SELECT *, row_number() OVER (PARTITION BY exchange, symbol
        ORDER BY window_start DESC) AS rn FROM bars WHERE window_start >= {AS_OF} - INTERVAL '720 hours')
        SELECT {BAR} FROM r WHERE rn <= 60""",
    "bars_with_count": f"""{MINUTE_BAR}, r AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY window_start DESC) AS rn
        FROM bars WHERE window_start >= {AS_OF} - INTERVAL '48 hours'),
        s AS (SELECT *, count(*) OVER (PARTITION BY symbol) AS n FROM r WHERE rn <= 60)
        SELECT * REPLACE (upper(symbol) AS symbol) FROM (SELECT {BAR}, n AS "count" FROM s)""",
    "newest_bars": f"""{MINUTE_BAR} SELECT {BAR} FROM bars WHERE symbol = 'view'
        AND window_start >= {AS_OF} - INTERVAL '2 hours' ORDER BY window_start DESC LIMIT 10""",
    "historical_bars": f"""{HOUR_BAR} SELECT {BAR} FROM bars WHERE lower(symbol) = 'view'
        AND window_start >= TIMESTAMP '2024-01-03' AND window_end <= TIMESTAMP '2024-01-25 12:00:00'
        ORDER BY window_start DESC LIMIT 300""",
    "lag_list": f"""WITH {TICKS}, {HEALTH}, t AS (SELECT count(*) FILTER (WHERE freshness_status = 'FRESH') AS healthy_count,
        count(*) AS total_count, {AS_OF} AS checked_at FROM health) SELECT * FROM health, t ORDER BY symbol""",
    "symbol_list": f"WITH {CDC} SELECT symbol, exchange, status, base_asset, quote_asset, updated_at FROM config",
    "gauge_feed": f"""{MART} {GAUGE.format("mid_price", "market_mid_price_usd")}
        UNION ALL {GAUGE.format("spread_bps", "market_spread_bps")}
        UNION ALL {GAUGE.format("coalesce(imbalance, 0)", "market_bid_ask_imbalance")}
        UNION ALL {GAUGE.format("staleness_seconds", "market_staleness_seconds")}
        UNION ALL SELECT symbol, exchange, 'pipeline_health_score', health_score FROM health""",
    "audit_listing": f"WITH {CDC} SELECT op, symbol, k AS source_lsn FROM audit ORDER BY k LIMIT 25",
    "recent_counts": f"""{MINUTE_BAR} SELECT 'book_ticker' AS table_name, count(*) AS recent_rows FROM ticks
        WHERE exchange_event_ts >= {AS_OF} - INTERVAL '2 hours'
        UNION ALL SELECT 'ohlcv_1m', count(*) FROM bars WHERE window_start >= {AS_OF} - INTERVAL '2 hours'""",
    "parse_events": f"""WITH {DIFFS}, {PAYLOADS} SELECT event_id, exchange, symbol, exchange_event_ts, ingest_ts, processed_ts,
        first_update_id, last_update_id, {LEVEL_TEXT}, kafka_topic, kafka_partition, kafka_offset FROM parsed""",
    "parse_wire": f"""WITH {DIFFS} SELECT event_id, exchange, symbol,
        date_trunc('milliseconds', exchange_event_ts) AS exchange_event_ts, processed_ts AS ingest_ts, processed_ts,
        first_update_id, last_update_id, {LEVEL_TEXT}, 'market.raw.orderbook' AS kafka_topic, kafka_partition, kafka_offset
        FROM diffs WHERE n % 97 <> 0 AND n % 89 <> 0 AND n % 83 <> 0""",
    "dlq_rejects": f"""WITH {DIFFS}, {PAYLOADS} SELECT CAST(NULL AS VARCHAR) AS original_key,
        coalesce(payload, '') AS original_payload, error_type, {MESSAGE} AS error_message, processed_ts AS ingest_ts
        FROM judged WHERE error_type IS NOT NULL""",
    "wire_rejects": f"""WITH {DIFFS} SELECT 'sim#' || symbol AS original_key,
        CASE WHEN n % 89 = 0 THEN 'missing_field' ELSE 'bad_levels' END AS error_type, processed_ts AS ingest_ts
        FROM diffs WHERE n % 89 = 0 OR n % 83 = 0""",
    "epoch_coercion": """SELECT event_id AS kafka_offset,
        CASE event_id % 5 WHEN 3 THEN (epoch_us(date_trunc('second', ts)) // 1000) WHEN 4 THEN NULL ELSE (epoch_us(ts) // 1000) END AS event_ms,
        CASE event_id % 5 WHEN 3 THEN (epoch_us(date_trunc('second', ts)) // 1000) ELSE (epoch_us(ts) // 1000) END AS event_ms_or_now,
        date_trunc('second', ts) AS from_seconds FROM events""",
    "decode_topic": f"""WITH {DIFFS}, {PAYLOADS} SELECT payload, kafka_partition, kafka_offset FROM raw
        WHERE payload IS NOT NULL""",
    "keyed_messages": f"""WITH {TICKS} SELECT exchange || '#' || symbol AS key, event_id,
        {ISO.format("exchange_event_ts")} AS exchange_event_ts, mid_price, kafka_offset FROM ticks""",
    "ticker_topic_source": f"""WITH {TICKS} SELECT * REPLACE (
        date_trunc('milliseconds', exchange_event_ts) AS exchange_event_ts,
        date_trunc('milliseconds', ingest_ts) AS ingest_ts, date_trunc('milliseconds', processed_ts) AS processed_ts)
        FROM ticks""",
    "cdc_changelog": f"""WITH {CDC} SELECT symbol, k AS source_lsn, 'INSERT' AS row_kind, status FROM audit
        WHERE op IN ('r', 'c')
        UNION ALL SELECT symbol, k, unnest(['UPDATE_BEFORE', 'UPDATE_AFTER']), status FROM audit WHERE op = 'u'
        UNION ALL SELECT symbol, k, 'DELETE', status FROM audit WHERE op = 'd'""",
    "materialized_marts": f"WITH {TICKS}, {bars('6 hours')} SELECT {BAR} FROM bars",
    "monotone_dedup": f"""WITH {SEQ}, {seq("seq_all")}, {SEEN} SELECT exchange, symbol, last_update_id, kafka_offset
        FROM flags WHERE NOT is_stale""",
    "late_routing": f"""WITH {DIFFS} SELECT event_id, symbol, CAST(lag_s AS DOUBLE) AS lag_s,
        CASE WHEN lag_s > 30 THEN 'late_event' END AS error_type FROM diffs""",
    "sequence_classes": f"""WITH {SEQ}, {seq("seq_all")}, {SEEN} SELECT symbol, kafka_offset, last_seen_id, is_stale, is_gap,
        CAST(sum(CASE WHEN is_gap THEN 1 ELSE 0 END) OVER (PARTITION BY symbol ORDER BY kafka_offset) AS BIGINT)
        AS segment_id FROM flags""",
    "gap_report": f"""WITH {SEQ}, {seq("seq_all")}, {SEEN} SELECT exchange, symbol, kafka_partition, kafka_offset,
        last_seen_id + 1 AS expected_update_id, first_update_id, last_update_id,
        first_update_id - last_seen_id - 1 AS missing_ids FROM flags WHERE is_gap""",
    "order_book_ticker": f"WITH {DIFFS}, {ON_TIME}, {lifetimes('symbol')} SELECT {TICKER} FROM ticker",
    "replay_idempotent": f"""WITH {SEQ}, {seq("seq_first", "usable")}, {lifetimes("symbol")}
        SELECT {TICKER} FROM ticker""",
    "snapshot_init": f"""WITH {SEQ}, {seq("seq_all")}, {SEEN}, {SNAPSHOTS}, {USABLE},
        {lifetimes("symbol, snapshot_id", SNAPSHOT_LEVELS)} SELECT {TICKER}, snapshot_id FROM ticker""",
    "book_imbalance_top5": f"""WITH {SNAPSHOTS} SELECT 'sim' AS exchange, symbol, last_update_id,
        CAST(max(bid) AS DOUBLE) AS best_bid_price, CAST(arg_max(bid_qty, bid) AS DOUBLE) AS best_bid_qty,
        CAST(min(ask) AS DOUBLE) AS best_ask_price, CAST(arg_min(ask_qty, ask) AS DOUBLE) AS best_ask_qty,
        CAST(sum(bid_qty) FILTER (WHERE i < 5) AS DOUBLE) AS bid_volume,
        CAST(sum(ask_qty) FILTER (WHERE i < 5) AS DOUBLE) AS ask_volume,
        round(sum(bid_qty) FILTER (WHERE i < 5) / CAST(sum(bid_qty + ask_qty) FILTER (WHERE i < 5) AS DOUBLE), 6) AS imbalance
        FROM images GROUP BY symbol, last_update_id""",
    "cdc_bronze": f"WITH {CDC} {AUDIT}",
    "cdc_rejects": f"""WITH {CDC} SELECT CASE WHEN error_type = 'unknown_op' AND k % 223 <> 0 THEN symbol END AS original_key,
        error_type, CASE error_type WHEN 'malformed_json' THEN 'payload is not a valid envelope'
        WHEN 'unknown_op' THEN 'operation code is not one of r, c, u, d' ELSE 'both row images are null' END AS error_message
        FROM chg WHERE error_type IS NOT NULL""",
    "cdc_current_state": f"WITH {CDC} SELECT * FROM config",
    "offset_ranges": f"WITH {RECORDS}, {ranges()} SELECT * FROM ranges",
    "offset_ranges_for_symbol": f"""WITH {RECORDS}, {ranges("symbol = 'view'")} SELECT * FROM ranges""",
    "time_offset_ranges": f"""WITH {RECORDS}, {time_ranges("2024-01-10", "2024-01-12 06:00:00")}
        SELECT * FROM time_ranges""",
    "time_offset_ranges_open": f"WITH {RECORDS}, {time_ranges('2024-01-20', '2024-02-20')} SELECT * FROM time_ranges",
    "replay_rows": f"WITH {RECORDS}, {ranges()} SELECT {RECORD} FROM records r JOIN ranges g ON {IN_RANGE}",
    "replay_rows_for_symbol": f"""WITH {RECORDS}, {ranges("symbol = 'view'")} SELECT {RECORD}
        FROM records r JOIN ranges g ON {IN_RANGE} WHERE r.symbol = 'view'""",
    "replay_fallback": f"""WITH {RECORDS}, {time_ranges("2024-01-10", "2024-01-12 06:00:00")}
        SELECT {RECORD}, 'topic_time' AS offset_source FROM records r JOIN time_ranges g ON {IN_RANGE}""",
    "replay_capped": f"""WITH {RECORDS}, {ranges()} SELECT {RECORD} FROM records r JOIN ranges g ON {IN_RANGE}
        ORDER BY r.kafka_partition, r.kafka_offset LIMIT 300""",
    "replay_stats": f"""WITH {RECORDS}, {ranges()} SELECT TRUE AS dry_run, 'market.raw.orderbook' AS source_topic,
        'market.raw.orderbook' AS target_topic, TIMESTAMP '2024-01-10' AS start_ts, TIMESTAMP '2024-01-12 06:00:00' AS end_ts,
        CAST(NULL AS VARCHAR) AS symbol, count(*) AS events_read, CAST(0 AS BIGINT) AS events_produced,
        string_agg(DISTINCT CAST(r.kafka_partition AS VARCHAR), ',' ORDER BY CAST(r.kafka_partition AS VARCHAR))
        AS partitions_replayed, 'silver' AS offset_source FROM records r JOIN ranges g ON {IN_RANGE}""",
    "replay_stats_for_symbol": f"""WITH {RECORDS}, {ranges("symbol = 'view'")} SELECT TRUE AS dry_run,
        'market.raw.orderbook' AS source_topic, 'market.raw.orderbook' AS target_topic,
        TIMESTAMP '2024-01-10' AS start_ts, TIMESTAMP '2024-01-12 06:00:00' AS end_ts, 'VIEW' AS symbol,
        (SELECT count(*) FROM records r JOIN ranges g ON {IN_RANGE}
         WHERE r.symbol = 'view' AND r.kafka_partition <> 3) AS events_read, CAST(0 AS BIGINT) AS events_produced,
        string_agg(CAST(kafka_partition AS VARCHAR), ',' ORDER BY kafka_partition) AS partitions_replayed,
        'silver' AS offset_source FROM ranges""",
    "dq_report": _dq_report(),
    "dq_violations": f"""WITH {TICKS}, t AS (SELECT *, CASE WHEN kafka_offset % 11 = 0 THEN NULL ELSE kafka_partition END
        AS lineage FROM ticks),
        by_lineage AS (SELECT lineage, count(*) AS n FROM t WHERE lineage IS NOT NULL GROUP BY lineage)
        SELECT *, failures = 0 AS passed FROM (
        {_checks("book_ticker", "t", [
            _null_rule("lineage"),
            ("between", "best_bid_price", "count(*) FILTER (WHERE best_bid_price NOT BETWEEN 150 AND 400)", "count(*)"),
            ("between", "best_bid_qty", "count(*) FILTER (WHERE best_bid_qty < 1)", "count(*)"),
            ("unique", "event_id", "count(event_id) - count(DISTINCT event_id)", "count(event_id)"),
            ("accepted_values", "symbol", "count(*) FILTER (WHERE symbol NOT IN ('view', 'click'))", "count(*)"),
            ("row_count", "", "CASE WHEN count(*) < 1000000000 THEN 1 ELSE 0 END", "count(*)"),
        ])}
        UNION ALL {_checks("book_ticker", "by_lineage", [
            ("unique", "lineage", "count(*) FILTER (WHERE n > 1)", "sum(n)")])})""",
    "dq_recent": f"""{MINUTE_BAR},
        t AS (SELECT * FROM ticks WHERE exchange_event_ts > TIMESTAMP '2024-01-30 23:00:00' - INTERVAL '600 minutes'),
        b AS (SELECT * FROM bars WHERE last_ts > TIMESTAMP '2024-03-01' - INTERVAL '10 minutes')
        SELECT *, failures = 0 AS passed FROM (
        {_checks("book_ticker", "t", [_null_rule("exchange"), _null_rule("symbol"), _null_rule("exchange_event_ts"),
            _low_rule("best_bid_price"), _low_rule("best_ask_price"), _EMPTY])}
        UNION ALL {_checks("ohlcv_1m", "b", [_null_rule("exchange"), _null_rule("symbol"), _null_rule("last_ts"), _EMPTY])})""",
    "source_freshness": f"""{MINUTE_BAR}, m AS (SELECT 'book_ticker' AS table_name, max(ingest_ts) AS max_loaded_at FROM ticks
        UNION ALL SELECT 'ohlcv_1m', max(last_ts) FROM bars)
        SELECT *, {_age("max_loaded_at")} AS age_seconds,
        CASE WHEN max_loaded_at < {AS_OF} - INTERVAL '5 minutes' THEN 'error'
             WHEN max_loaded_at < {AS_OF} - INTERVAL '2 minutes' THEN 'warn' ELSE 'pass' END AS status FROM m""",
    "stream_ohlcv": f"""{HOUR_BAR} SELECT {BAR}, CAST(window_start AS DATE) AS event_date FROM bars
        WHERE window_end <= (SELECT max(exchange_event_ts) FROM ticks) - INTERVAL '5 seconds'""",
    "stream_bars_retried": f"""{HOUR_BAR} SELECT {BAR}, CAST(window_start AS DATE) AS event_date FROM bars
        WHERE window_end <= (SELECT max(exchange_event_ts) FROM ticks) - INTERVAL '5 seconds'""",
    "stream_ticker": f"""WITH {DIFFS}, {PAYLOADS}, usable AS (SELECT * FROM parsed
        WHERE (epoch_us(processed_ts) // 1000) - (epoch_us(exchange_event_ts) // 1000) <= 30000), {lifetimes("symbol")}
        SELECT {TICKER} FROM ticker""",
    "stream_dead_letters": f"""WITH {DIFFS}, {PAYLOADS}, bad AS (
        SELECT CAST(NULL AS VARCHAR) AS key, error_type, processed_ts FROM judged WHERE error_type IS NOT NULL
        UNION ALL SELECT exchange || '#' || symbol, 'late_event', processed_ts FROM parsed
        WHERE (epoch_us(processed_ts) // 1000) - (epoch_us(exchange_event_ts) // 1000) > 30000)
        SELECT key, error_type, {MESSAGE} AS error_message, {ISO.format("processed_ts")} AS ingest_ts FROM bad""",
    "stream_topic": f"""WITH {DIFFS}, {PAYLOADS}, usable AS (SELECT * FROM parsed
        WHERE (epoch_us(processed_ts) // 1000) - (epoch_us(exchange_event_ts) // 1000) <= 30000), {lifetimes("symbol")}
        SELECT exchange || '#' || symbol AS key, event_id, {ISO.format("exchange_event_ts")} AS exchange_event_ts,
        (best_bid_price + best_ask_price) / 2 AS mid_price FROM ticker""",
    "stream_cdc_bronze": f"WITH {CDC} {AUDIT}",
    "stream_cdc_state": f"WITH {CDC} SELECT * FROM config",
    "overwrite_idempotent": f"{HOUR_BAR} SELECT {BAR}, CAST(window_start AS DATE) AS event_date FROM bars",
    "compaction": f"WITH {TICKS} SELECT *, 0 AS small_folders FROM ticks",
}
# Streams equal their batch twins.
ORACLES["stream_snapshot_init"] = ORACLES["snapshot_init"]
ORACLES["stream_gap_report"] = ORACLES["gap_report"]
ORACLES["stream_typed_source"] = ORACLES["parse_events"]
ORACLES["dq_observed"] = ORACLES["dq_report"]
_NOW_AGE = "epoch(now()) - epoch(latest_ts)"
ORACLES["live_marts"] = f"""{MART} SELECT exchange, symbol, latest_ts, spread_bps, market_signal,
    CASE WHEN {_NOW_AGE} < 61 THEN 'FRESH' WHEN {_NOW_AGE} < 121 THEN 'WARN' ELSE 'STALE' END AS freshness_status,
    CASE WHEN {_NOW_AGE} < 61 THEN 1.0::DOUBLE WHEN {_NOW_AGE} < 121 THEN 0.5 ELSE 0.0 END AS health_score,
    {_NOW_AGE} >= 86400 AS stale_for_days FROM liquidity"""
# Merged bars add exact decimals, whose sum is the same in any order, and are compared to nine places.
_WEIGHTED = "sum(mid_price * best_bid_qty)"
_EXACT_WEIGHTED = "CAST(sum(CAST(mid_price * best_bid_qty AS DECIMAL(38, 10))) AS DOUBLE)"
ORACLES["bar_merge"] = ORACLES["stream_bar_merge"] = (
    ORACLES["ohlcv_bars"].replace(_WEIGHTED, _EXACT_WEIGHTED).replace(", 6) AS", ", 9) AS")
)
ORACLES["stream_changelog"] = f"""WITH {CDC}, steps AS (SELECT *, lag(op) OVER log AS old_op, lag(status) OVER log AS old_status,
        lag(tick_size) OVER log AS old_size FROM audit WINDOW log AS (PARTITION BY symbol ORDER BY k)),
    known AS (SELECT *, coalesce(old_op, 'd') <> 'd' AS held FROM steps)
    SELECT symbol, k AS source_lsn, 'INSERT' AS row_kind, status, tick_size FROM known WHERE op <> 'd' AND NOT held
    UNION ALL SELECT symbol, k, 'UPDATE_BEFORE', old_status, old_size FROM known WHERE op <> 'd' AND held
    UNION ALL SELECT symbol, k, 'UPDATE_AFTER', status, tick_size FROM known WHERE op <> 'd' AND held
    UNION ALL SELECT symbol, k, 'DELETE', old_status, old_size FROM known WHERE op = 'd' AND held"""
ORACLES["order_book_quiet"] = ORACLES["order_book_ticker"].replace("event_type AS symbol", "'Q' || (event_id % 300) AS symbol")
