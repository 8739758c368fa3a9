"""Independent DuckDB SQL for every registered query (run on the same parquet views).

The rollup arithmetic mirrors Spark's decimal rules in integers: each price*volume
product is rounded half-up to 6 places (decimal(38,8) x decimal(38,8) -> decimal(38,6)),
and vwap = quote_volume / volume is rounded half-up to 6 places. Prices are held as
integer units of 1e-8 (p8), volumes are whole numbers in both adapters, and every
half-up formula assumes non-negative operands (true for both adapters).
Timestamps leave as epoch millis, floored (``epoch_us // 1000``).
"""

from __future__ import annotations

# ---------------------------------------------------------------- adapters (CTE bodies)
K = "CAST(json_extract_string(props, '$.k') AS BIGINT)"

EVQ = f"""evq AS (
  SELECT event_type AS symbol,
         CAST(value AS DECIMAL(38,8)) AS price,
         CAST(json_extract_string(props, '$.k') AS DECIMAL(38,8)) AS volume,
         {K} AS units,
         CAST(SUM({K}) OVER (PARTITION BY event_type, CAST(ts AS DATE) ORDER BY ts, event_id
                        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS day_volume,
         ts AS quote_time, event_id, value
  FROM events)"""

LIQ = """liq AS (
  SELECT CAST(l_suppkey AS VARCHAR) AS symbol,
         CAST(l_extendedprice / l_quantity AS DECIMAL(38,8)) AS price,
         CAST(l_quantity AS DECIMAL(38,8)) AS volume,
         CAST(SUM(CAST(l_quantity AS BIGINT)) OVER (PARTITION BY l_suppkey, CAST(l_shipdate AS DATE)
             ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice,
                      l_discount, l_tax, l_returnflag, l_linestatus
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS day_volume,
         l_shipdate AS quote_time
  FROM lineitem)"""


def ms(expr: str) -> str:
    return f"(epoch_us({expr}) // 1000)"


def bars_cte(src: str, width: str, name: str = "bars", where: str = "") -> str:
    """Bars with integer money columns, then doubles; D2 tie-break on (time, day_volume, price)."""
    return f"""{name}_q AS (
  SELECT symbol, price, volume, day_volume, quote_time,
         CAST(replace(CAST(CAST(price AS DECIMAL(18,8)) AS VARCHAR), '.', '') AS HUGEINT) AS p8,
         CAST(volume AS HUGEINT) AS v
  FROM {src} {where}),
{name}_i AS (
  SELECT symbol, time_bucket(INTERVAL '{width}', quote_time) AS ws,
         arg_min(price, (quote_time, day_volume, price)) AS open_p,
         max(price) AS high_p, min(price) AS low_p,
         arg_max(price, (quote_time, day_volume, price)) AS close_p,
         sum(v) AS vol, sum((2 * p8 * v + 100) // 200) AS qv6, count(*) AS trade_count
  FROM {name}_q WHERE quote_time IS NOT NULL GROUP BY ALL),
{name} AS (
  SELECT symbol, ws AS window_start, ws + INTERVAL '{width}' AS window_end,
         CAST(open_p AS DOUBLE) AS open, CAST(high_p AS DOUBLE) AS high,
         CAST(low_p AS DOUBLE) AS low, CAST(close_p AS DOUBLE) AS close,
         CAST(vol AS DOUBLE) AS volume, CAST(qv6 AS DOUBLE) / 1000000.0 AS quote_volume,
         CASE WHEN vol > 0 THEN CAST((2 * qv6 + vol) // (2 * vol) AS DOUBLE) / 1000000.0
              ELSE CAST(close_p AS DOUBLE) END AS vwap,
         trade_count
  FROM {name}_i)"""


BAR_COLS = (f"symbol, {ms('window_start')} AS window_start_ms, {ms('window_end')} AS window_end_ms, "
            "open, high, low, close, volume, quote_volume, vwap, trade_count")
SERVE_COLS = (f"symbol, {ms('window_start')} AS window_start_ms, open, high, low, close, volume, vwap, trade_count")


def _bars_query(src_cte: str, src: str, width: str, where: str = "") -> str:
    return f"WITH {src_cte},\n{bars_cte(src, width, where=where)}\nSELECT {BAR_COLS} FROM bars"


EV_1M = f"WITH {EVQ},\n{bars_cte('evq', '1 minute')}"

TICK_ORDER_DESC = "quote_time DESC, day_volume DESC, price DESC"

INCREMENTS = f"""WITH {EVQ}
SELECT symbol, {ms('quote_time')} AS quote_time_ms, day_volume,
       CAST(COALESCE(GREATEST(0, day_volume - LAG(day_volume) OVER (
           PARTITION BY symbol ORDER BY quote_time, day_volume, price)), 0) AS BIGINT) AS volume
FROM evq"""

QUOTE_COLS = (f"symbol, CAST(price AS DOUBLE) AS price, CAST(volume AS DOUBLE) AS volume, day_volume, "
              f"{ms('quote_time')} AS quote_time_ms")


def _late_report() -> str:
    return f"""WITH {EVQ},
wm AS (SELECT date_trunc('millisecond', max(quote_time) FILTER (WHERE units >= 10))
              - INTERVAL '2 minutes' AS wm FROM evq),
tagged AS (
  SELECT symbol, time_bucket(INTERVAL '1 minute', quote_time) AS ws,
         units < 10 AND time_bucket(INTERVAL '1 minute', quote_time) + INTERVAL '1 minute' <= wm AS dropped
  FROM evq, wm),
per AS (SELECT symbol, ws, count(*) AS raw_tc, count(*) FILTER (WHERE NOT dropped) AS bar_tc
        FROM tagged GROUP BY ALL)
SELECT symbol, {ms('ws')} AS window_start_ms,
       CASE WHEN bar_tc = 0 THEN 'missing' ELSE 'differs' END AS status,
       raw_tc AS raw_trade_count,
       CASE WHEN bar_tc = 0 THEN NULL ELSE bar_tc END AS bar_trade_count
FROM per WHERE raw_tc <> bar_tc"""


def _days_report() -> str:
    return f"""WITH {EVQ},
per AS (SELECT symbol, time_bucket(INTERVAL '1 minute', quote_time) AS ws, count(*) AS raw_tc,
               count(*) FILTER (WHERE day(quote_time) NOT IN (5, 20) OR units >= 30) AS bar_tc
        FROM evq GROUP BY ALL)
SELECT symbol, {ms('ws')} AS window_start_ms, CASE WHEN bar_tc = 0 THEN 'missing' ELSE 'differs' END AS status,
       raw_tc AS raw_trade_count, CASE WHEN bar_tc = 0 THEN NULL ELSE bar_tc END AS bar_trade_count
FROM per WHERE raw_tc <> bar_tc"""


# fixed rule set used by the quarantine scenario (see plans/queries.py)
QUARANTINE = f"""WITH {EVQ}
SELECT status, count(*) AS n FROM (
  SELECT CASE
    WHEN symbol = 'signup' AND units >= 98 THEN 'null_value'
    WHEN units = 6 THEN 'short_frame'
    WHEN units = 7 THEN 'bad_magic'
    WHEN units = 8 THEN 'bad_avro'
    WHEN units <= 2 THEN 'bad_price'
    WHEN units = 5 THEN 'bad_volume'
    WHEN units IN (3, 4) THEN 'negative_volume'
    ELSE 'valid' END AS status
  FROM evq) GROUP BY status"""

CHART = f"""WITH {EVQ}
SELECT symbol, {ms('quote_time')} AS quote_time_ms,
       COALESCE(CASE WHEN symbol = 'error' THEN NULL ELSE value END,
                CASE WHEN units > 50 THEN value WHEN units > 10 THEN value + 1 END) AS price,
       3 * units AS day_volume,
       CASE WHEN symbol = 'error' AND units <= 10 THEN 'no_price' END AS reject_reason
FROM evq"""

CHART_ODD = f"""WITH {EVQ},
c AS (SELECT symbol, quote_time, units, units % 10 AS kind,
             CASE WHEN symbol = 'error' OR units % 10 IN (0, 4, 5) THEN NULL ELSE value END AS market,
             CASE WHEN units % 10 IN (3, 4, 5) THEN NULL WHEN units > 50 THEN value WHEN units > 10 THEN value + 1 END AS last_close
      FROM evq)
SELECT symbol, {ms('quote_time')} AS quote_time_ms, coalesce(market, last_close) AS price,
       CASE WHEN kind IN (3, 4, 5) THEN 0 ELSE 3 * units END AS day_volume,
       CASE WHEN market IS NULL AND last_close IS NULL THEN 'no_price' END AS reject_reason
FROM c"""

ALLOW = f"""WITH {EVQ}
SELECT upper(symbol) AS symbol,
       CASE WHEN upper(symbol) IN ('CLICK', 'VIEW', 'PURCHASE') THEN 'accepted' ELSE 'rejected' END AS status,
       count(*) AS n
FROM evq GROUP BY ALL"""

NORMALIZE_SYMBOLS = f"""WITH {EVQ},
s AS (SELECT event_id,
        list_filter(list_transform(string_split(
            symbol || ', ' || upper(symbol) || ',,' || CASE WHEN units >= 50 THEN 'aapl' ELSE ' msft ' END
            || ',' || lower(symbol) || ' ', ','), lambda x: upper(trim(x))), lambda x: x <> '') AS l
      FROM evq)
SELECT event_id, array_to_string(list_filter(l, lambda x, i: list_position(l, x) = i), '|') AS symbols,
       len(list_filter(l, lambda x, i: list_position(l, x) = i)) AS n_symbols
FROM s"""

NORMALIZE_QUOTES = f"""WITH {EVQ}
SELECT symbol, CAST(value AS VARCHAR) AS price, CAST(units AS VARCHAR) AS volume, day_volume,
       {ms('quote_time')} AS quote_time_ms, {ms('quote_time')} AS ingest_time_ms, 'yahoo' AS source
FROM evq"""

WIRE = f"""WITH {EVQ}
SELECT {QUOTE_COLS}, {ms('quote_time')} AS ingest_time_ms, 'events' AS source,
       CAST(0 AS INTEGER) AS magic, CAST(1 AS BIGINT) AS schema_id
FROM evq"""

RAW = f"""WITH {EVQ}
SELECT {QUOTE_COLS}, 'events' AS source FROM evq"""

RECONCILE = f"""{EV_1M},
r AS (SELECT symbol, count(*) AS raw_rows, count(quote_time) AS timed_rows FROM evq GROUP BY symbol),
b AS (SELECT symbol, count(*) AS bars, sum(trade_count) AS bar_trades FROM bars GROUP BY symbol)
SELECT r.symbol, raw_rows, timed_rows, bars, CAST(bar_trades AS BIGINT) AS bar_trades,
       raw_rows >= 1 AND bars >= 1 AND bar_trades = timed_rows AS ok
FROM r JOIN b USING (symbol)"""

COUNT_ROWS = f"""{EV_1M}
SELECT 'quotes_raw' AS table_name, symbol, count(*) AS n FROM evq GROUP BY symbol
UNION ALL SELECT 'quotes_raw', NULL, count(*) FROM evq
UNION ALL SELECT 'ohlcv', symbol, count(*) FROM bars GROUP BY symbol
UNION ALL SELECT 'ohlcv', NULL, count(*) FROM bars"""

BAR_DOUBLES_1M = f"{EV_1M}\nSELECT {BAR_COLS} FROM bars"


EXACT_1M = f"""WITH {EVQ},
q AS (SELECT symbol, price, volume, day_volume, quote_time,
             CAST(replace(CAST(CAST(price AS DECIMAL(18,8)) AS VARCHAR), '.', '') AS HUGEINT) AS p8,
             CAST(volume AS HUGEINT) AS v
      FROM evq),
i AS (SELECT symbol, time_bucket(INTERVAL '1 minute', quote_time) AS ws,
             arg_min(price, (quote_time, day_volume, price)) AS open_p, max(price) AS high_p, min(price) AS low_p,
             arg_max(price, (quote_time, day_volume, price)) AS close_p,
             sum(v) AS vol, sum(p8 * v) AS qv8, count(*) AS trade_count
      FROM q GROUP BY ALL)
SELECT symbol, {ms('ws')} AS window_start_ms, {ms("ws + INTERVAL '1 minute'")} AS window_end_ms,
       CAST(open_p AS DOUBLE) AS open, CAST(high_p AS DOUBLE) AS high, CAST(low_p AS DOUBLE) AS low,
       CAST(close_p AS DOUBLE) AS close, CAST(vol AS DOUBLE) AS volume,
       CAST(qv8 AS DOUBLE) / 100000000.0 AS quote_volume,
       CASE WHEN vol > 0 THEN CAST((2 * qv8 + vol) // (2 * vol) AS DOUBLE) / 100000000.0
            ELSE CAST(close_p AS DOUBLE) END AS vwap,
       trade_count
FROM i"""


def oracle_sql() -> dict[str, str]:
    return {
        "ohlcv_exact": EXACT_1M,
        "keyed_topic_roundtrip": RAW,
        "latest_bars_table": f"{EV_1M}\nSELECT * FROM (SELECT {SERVE_COLS} FROM bars WHERE symbol = 'click' "
                             "ORDER BY window_start DESC LIMIT 120)",
        "latest_ticks_table": f"WITH {EVQ}\nSELECT * FROM (SELECT symbol, CAST(price AS DOUBLE) AS price, "
                              f"CAST(volume AS DOUBLE) AS quantity, {ms('quote_time')} AS trade_time_ms FROM evq "
                              f"WHERE symbol = 'click' ORDER BY {TICK_ORDER_DESC} LIMIT 40)",
        "compact_bars": BAR_DOUBLES_1M,
        "ohlcv_1m": _bars_query(EVQ, "evq", "1 minute"),
        "ohlcv_1h": _bars_query(EVQ, "evq", "1 hour"),
        "ohlcv_1d": _bars_query(EVQ, "evq", "1 day"),
        "ohlcv_ties": _bars_query(LIQ, "liq", "1 day"),
        "normalize_quotes": NORMALIZE_QUOTES,
        "wire_roundtrip": WIRE,
        "bars_wire_roundtrip": BAR_DOUBLES_1M,
        "quarantine_counts": QUARANTINE,
        "chart_json": CHART,
        "chart_json_odd": CHART_ODD,
        "volume_increments": INCREMENTS,
        "volume_increments_split": INCREMENTS,
        "ohlcv_1m_split": _bars_query(EVQ, "evq", "1 minute"),
        "increments_stream": INCREMENTS,
        "latest_bars": f"{EV_1M}\nSELECT * FROM (SELECT {SERVE_COLS} FROM bars WHERE symbol = 'click' "
                       "ORDER BY window_start DESC LIMIT 120)",
        "latest_ticks": f"WITH {EVQ}\nSELECT * FROM (SELECT symbol, CAST(price AS DOUBLE) AS price, "
                        f"CAST(volume AS DOUBLE) AS quantity, {ms('quote_time')} AS trade_time_ms FROM evq "
                        f"WHERE symbol = 'click' ORDER BY {TICK_ORDER_DESC} LIMIT 40)",
        "latest_bars_all": f"{EV_1M}\nSELECT * FROM (SELECT {SERVE_COLS} FROM bars "
                           "ORDER BY window_start DESC, symbol ASC LIMIT 10)",
        "topn_per_symbol": f"{EV_1M}\nSELECT {SERVE_COLS}, rn FROM (SELECT *, row_number() OVER "
                           "(PARTITION BY symbol ORDER BY window_start DESC) AS rn FROM bars) WHERE rn <= 120",
        "recent_bars": f"{EV_1M}\nSELECT {SERVE_COLS}, rn FROM (SELECT *, row_number() OVER "
                       "(PARTITION BY symbol ORDER BY window_start DESC) AS rn FROM bars) WHERE rn <= 12",
        "latest_price": f"WITH {EVQ}\nSELECT symbol, CAST(arg_max(price, (quote_time, day_volume, price)) AS DOUBLE) "
                        f"AS price, {ms('max(quote_time)')} AS trade_time_ms FROM evq GROUP BY symbol",
        "tick_direction": f"""WITH {EVQ},
ranked AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY {TICK_ORDER_DESC}) AS rn FROM evq)
SELECT symbol, rn, CAST(price AS DOUBLE) AS price, CAST(volume AS DOUBLE) AS quantity,
       {ms('quote_time')} AS trade_time_ms,
       CASE WHEN LEAD(price) OVER (PARTITION BY symbol ORDER BY rn) IS NULL
              OR price >= LEAD(price) OVER (PARTITION BY symbol ORDER BY rn) THEN 'up' ELSE 'down' END AS side
FROM ranked WHERE rn <= 40""",
        "close_series_summary": f"""{EV_1M},
ranked AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY window_start DESC) AS rn FROM bars),
s AS (SELECT symbol, count(*) AS points, min(close) AS min_close, max(close) AS max_close,
             arg_min(close, window_start) AS first_close, arg_max(close, window_start) AS last_close
      FROM ranked WHERE rn <= 120 GROUP BY symbol)
SELECT symbol, points, min_close, max_close,
       CASE WHEN max_close - min_close = 0 THEN 1.0 ELSE max_close - min_close END AS close_range,
       first_close, last_close, CASE WHEN last_close >= first_close THEN 'up' ELSE 'down' END AS direction
FROM s WHERE points >= 2""",
        "allowlist_symbols": ALLOW,
        "normalize_symbols": NORMALIZE_SYMBOLS,
        "upsert_bars": BAR_DOUBLES_1M,
        "backfill_bars": BAR_DOUBLES_1M,
        "stream_ohlcv": BAR_DOUBLES_1M,
        "stream_raw": RAW,
        "late_rows_report": _late_report(),
        "late_days_report": _days_report(),
        "backfill_days": BAR_DOUBLES_1M,
        "open_windows": f"{EV_1M}\nSELECT {BAR_COLS}, 'same' AS status FROM bars WHERE window_end > "
                        "(SELECT date_trunc('millisecond', max(quote_time)) - INTERVAL '2 minutes' FROM evq)",
        "topn_stream": f"{EV_1M}\nSELECT {SERVE_COLS}, rn FROM (SELECT *, row_number() OVER "
                       "(PARTITION BY symbol ORDER BY window_start DESC) AS rn FROM bars) WHERE rn <= 120",
        "stream_counters": QUARANTINE,
        "reconcile_counts": RECONCILE,
        "stream_reconcile": RECONCILE,
        "count_rows": COUNT_ROWS,
        "replay_roundtrip": f"{EV_1M}\nSELECT symbol, {ms('window_start')} AS window_start_ms, open, high, low, "
                            "close, volume, quote_volume, vwap, trade_count FROM (SELECT *, row_number() OVER "
                            "(PARTITION BY symbol ORDER BY window_start DESC) AS rn FROM bars) WHERE rn <= 12",
        "replay_ticks": f"""{EV_1M}, shown AS (SELECT symbol, min(window_start) AS since FROM (SELECT *, row_number() OVER
  (PARTITION BY symbol ORDER BY window_start DESC) AS rn FROM bars) WHERE rn <= 12 GROUP BY symbol)
SELECT symbol, {ms('quote_time')} AS t, CAST(price AS DOUBLE) AS price, CAST(volume AS BIGINT) AS quantity
FROM evq JOIN shown USING (symbol) WHERE quote_time >= since""",
        "topic_stream_bars": _bars_query(EVQ, "evq", "1 minute"),
        "bars_topic": _bars_query(EVQ, "evq", "1 minute"),
        "stream_restart": RECONCILE,
        "raw_append_after_stream": RAW,
        "table_append": RAW,
        "append_retry": f"{RAW} UNION ALL SELECT {QUOTE_COLS}, 'events' AS source FROM evq WHERE day(quote_time) <= 3",
        "topic_replayed_batch": RAW,
        "null_event_time": _bars_query(EVQ, "evq", "1 minute", "WHERE units >= 10"),
        "stream_raw_all": f"""WITH {EVQ}, s AS ({QUARANTINE[QUARANTINE.index('SELECT CASE'):QUARANTINE.index(') GROUP BY')]})
SELECT 'raw' AS held, count(*) AS n FROM s WHERE status NOT IN ('null_value', 'short_frame', 'bad_magic', 'bad_avro')
UNION ALL SELECT 'bars', count(*) FROM s WHERE status NOT IN ('null_value', 'short_frame', 'bad_magic', 'bad_avro')
UNION ALL SELECT status, count(*) FROM s WHERE status <> 'valid' GROUP BY status""",
        "cast_quote_columns": f"""WITH {EVQ}
SELECT CASE WHEN symbol = 'signup' AND units >= 98 THEN NULL ELSE symbol END AS symbol,
       CASE WHEN units > 2 THEN CAST(price AS DOUBLE) END AS price,
       CASE WHEN units IN (3, 4) THEN -units WHEN units = 5 THEN NULL ELSE CAST(volume AS DOUBLE) END AS volume,
       {ms('quote_time')} AS quote_time_ms FROM evq""",
        "publish_pipeline": f"""WITH {EVQ}, c AS ({CHART[CHART.index('SELECT symbol'):]}),
k AS (SELECT symbol, CAST(price AS DECIMAL(38,8)) AS price, day_volume, quote_time_ms,
             lag(day_volume) OVER (PARTITION BY symbol ORDER BY quote_time_ms, day_volume, price) AS before
      FROM c WHERE reject_reason IS NULL)
SELECT symbol, CAST(price AS DOUBLE) AS price, CAST(greatest(0, coalesce(day_volume - before, 0)) AS DOUBLE) AS volume,
       day_volume, quote_time_ms, 'yahoo' AS source FROM k""",
    }
