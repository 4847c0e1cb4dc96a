"""DuckDB oracle SQL fragments: the same computations written as plain SQL.

Each fragment is one common table expression; ``with_ctes`` chains the ones a
query needs. Casts align DuckDB's result types with Spark's (INTEGER ranks and
hours, BIGINT counts) and order-dependent double aggregates are compared as
DECIMAL(38,6) on both sides.
"""

from __future__ import annotations

from candlewick.schema import INTERPRETATION_FORMAT


def _q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def with_ctes(ctes: list[tuple[str, str]], body: str) -> str:
    parts = ",\n".join(f"{name} AS (\n{sql}\n)" for name, sql in ctes)
    return f"WITH {parts}\n{body}"


def dec(expr: str, alias: str) -> str:
    return f"CAST({expr} AS DECIMAL(38,6)) AS {alias}"


def candles_sql(interval: str = "1h") -> str:
    unit, last_ms = {"1m": ("minute", 59_999), "1h": ("hour", 3_599_999), "1d": ("day", 86_399_999)}[interval]
    return f"""
SELECT symbol, '{interval}' AS "interval", open_time, open, high, low, close, volume,
       open_time + INTERVAL {last_ms} MILLISECOND AS close_time, quote_volume, trade_count
FROM (
  SELECT upper(event_type) || 'USDT' AS symbol,
         date_trunc('{unit}', ts) AS open_time,
         first(value ORDER BY ts, event_id) AS open,
         max(value) AS high,
         min(value) AS low,
         last(value ORDER BY ts, event_id) AS close,
         CAST(sum(CAST(value AS DECIMAL(24,8))) AS DOUBLE) AS volume,
         CAST(sum(CAST(value AS DECIMAL(24,8))
                  * CAST(json_extract_string(props, '$.k') AS DECIMAL(12,0))) AS DOUBLE) AS quote_volume,
         count(*) AS trade_count
  FROM events
  GROUP BY 1, 2
) t"""


CANDLES = candles_sql("1h")

LINEITEM_CANDLES = """
SELECT symbol, '1d' AS "interval", open_time, open, high, low, close, volume,
       open_time + INTERVAL 86399999 MILLISECOND AS close_time, quote_volume, trade_count
FROM (
  SELECT l_returnflag || l_linestatus || 'USDT' AS symbol,
         date_trunc('day', l_shipdate) AS open_time,
         first(l_extendedprice ORDER BY l_orderkey, l_linenumber, l_extendedprice) AS open,
         max(l_extendedprice) AS high,
         min(l_extendedprice) AS low,
         last(l_extendedprice ORDER BY l_orderkey, l_linenumber, l_extendedprice) AS close,
         CAST(sum(CAST(l_quantity AS DECIMAL(20,6))) AS DOUBLE) AS volume,
         CAST(sum(CAST(l_extendedprice AS DECIMAL(20,6))
                  * CAST(1 - CAST(l_discount AS DECIMAL(12,8)) AS DECIMAL(12,8))) AS DOUBLE) AS quote_volume,
         count(*) AS trade_count
  FROM lineitem
  GROUP BY 1, 2
) t"""


def features(src: str) -> str:
    return f"""
SELECT *,
       high - low AS price_range,
       close - open AS price_change,
       (close - open) / nullif(open, 0) * 100.0 AS percent_change,
       CASE WHEN close > open THEN 'up' WHEN close < open THEN 'down'
            WHEN close = open THEN 'flat' END AS candle_direction
FROM {src}"""


def time_features(src: str) -> str:
    return f"""
SELECT *,
       CAST(open_time AS DATE) AS trade_date,
       CAST(hour(open_time) AS INTEGER) AS trade_hour,
       strftime(open_time, '%a') AS day_of_week
FROM {src}"""


def summary_agg(src: str) -> str:
    return f"""
SELECT symbol,
       count(*) AS total_records,
       avg(volume) AS avg_volume,
       sum(trade_count) AS total_trades,
       avg(percent_change) AS avg_percent_change,
       avg(price_range) AS avg_price_range,
       stddev_samp(price_range) AS stddev_price_range,
       CAST(count_if(candle_direction = 'up') AS BIGINT) AS up_count,
       CAST(count_if(candle_direction = 'down') AS BIGINT) AS down_count,
       CAST(count_if(candle_direction = 'flat') AS BIGINT) AS flat_count,
       sum(quote_volume) AS total_quote_volume
FROM {src}
WHERE symbol IS NOT NULL
GROUP BY symbol"""


VOL_ORDER = "avg_price_range DESC NULLS LAST, stddev_price_range DESC NULLS LAST, symbol ASC NULLS LAST"
ACT_ORDER = "total_trades DESC NULLS LAST, total_quote_volume DESC NULLS LAST, symbol ASC NULLS LAST"


def summary_ranked(src: str) -> str:
    return f"""
SELECT *,
       CAST(row_number() OVER (ORDER BY {VOL_ORDER}) AS INTEGER) AS volatility_rank,
       CAST(row_number() OVER (ORDER BY {ACT_ORDER}) AS INTEGER) AS activity_rank
FROM {src}"""


def summary_select(src: str, trades_type: str = "BIGINT", quote_scale: int = 6) -> str:
    return f"""
SELECT symbol, total_records,
       {dec('avg_volume', 'avg_volume')},
       CAST(total_trades AS {trades_type}) AS total_trades,
       {dec('avg_percent_change', 'avg_percent_change')},
       {dec('avg_price_range', 'avg_price_range')},
       up_count, down_count, flat_count, volatility_rank, activity_rank,
       CAST(total_quote_volume AS DECIMAL(38,{quote_scale})) AS total_quote_volume,
       printf({_q(INTERPRETATION_FORMAT)}, symbol, volatility_rank) AS interpretation
FROM {src}"""
