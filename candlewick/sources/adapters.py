"""Candle tables derived from the driver's generic tables.

The driver data has no market candles, so two fixture adapters aggregate
candles out of event-like tables. Both are single ``groupBy`` aggregates whose
functions (min/max, min_by/max_by, sum, count) all combine map-side, so a hot
symbol is pre-aggregated before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.functions.exprs import ntz_epoch_micros, ntz_from_epoch_micros
from candlewick.schema import CANDLE_COLUMNS


def _day(ts):
    us = ntz_epoch_micros(ts)
    return ntz_from_epoch_micros(us - F.pmod(us, F.lit(86_400_000_000)))


def _close_time(open_time: str, interval_ms: int):
    return F.col(open_time) + F.expr(f"INTERVAL '{(interval_ms - 1) / 1000:.3f}' SECOND")


# Supported candle intervals: text -> (date_trunc unit, length in microseconds).
INTERVALS = {"1m": ("minute", 60_000_000), "1h": ("hour", 3_600_000_000), "1d": ("day", 86_400_000_000)}


def _decimal(c, digits: int, scale: int = 0):
    return c.cast(f"decimal({digits},{scale})")


def candles_from_events(events: DataFrame, interval: str = "1h") -> DataFrame:
    """One candle per (event_type, ``interval`` bucket of ts).

    symbol = upper(event_type) || 'USDT'; open/close = value of the first/last
    event; high/low = max/min value; volume = sum(value); quote_volume =
    sum(value * props.k); trade_count = number of events. Sums are decimals
    with eight places, so they do not depend on the summation order.

    "First" orders by (ts, event_id), both in full: one decimal(38,0) key,
    microsecond offset inside the candle * 2^64 + event_id. A decimal key has a
    fixed-width buffer and keeps ``min_by``/``max_by`` in a hash aggregate (a
    struct key forces a sort aggregate, about 3x slower).
    """
    _, length_us = INTERVALS[interval]
    value = _decimal(F.col("value"), 24, 8)
    k = _decimal(F.get_json_object("props", "$.k"), 12)
    # Bucketing is epoch arithmetic on the UTC wall clock (no session zone).
    us = ntz_epoch_micros("ts")
    offset = F.pmod(us, F.lit(length_us))
    bucket = ntz_from_epoch_micros(us - offset)
    order = _decimal(offset, 12) * _decimal(F.lit(str(2**64)), 20) + _decimal(F.col("event_id"), 20)
    agg = (
        events.select(
            F.concat(F.upper("event_type"), F.lit("USDT")).alias("symbol"),
            bucket.alias("open_time"),
            F.col("value"),
            value.alias("value_dec"),
            (value * k).alias("quote_dec"),
            _decimal(order, 38).alias("ord"),
        )
        .groupBy("symbol", "open_time")
        .agg(
            F.min_by("value", "ord").alias("open"),
            F.max("value").alias("high"),
            F.min("value").alias("low"),
            F.max_by("value", "ord").alias("close"),
            F.sum("value_dec").cast("double").alias("volume"),
            F.sum("quote_dec").cast("double").alias("quote_volume"),
            F.count(F.lit(1)).alias("trade_count"),
        )
    )
    return agg.select(
        "symbol",
        F.lit(interval).alias("interval"),
        F.col("open_time").cast("timestamp_ntz").alias("open_time"),
        "open",
        "high",
        "low",
        "close",
        "volume",
        _close_time("open_time", length_us // 1000).cast("timestamp_ntz").alias("close_time"),
        "quote_volume",
        "trade_count",
    )


def candles_from_lineitem(lineitem: DataFrame) -> DataFrame:
    """One daily candle per (returnflag || linestatus, ship date) of ``lineitem``.

    Prices are ``l_extendedprice``, volume is ``l_quantity``, quote volume is
    ``l_extendedprice * (1 - l_discount)``, summed as decimals with six digits
    of prices and quantities and eight of discounts. First/last order by (orderkey,
    linenumber, price); the price breaks ties because (orderkey, linenumber)
    is not unique in the generated data. The key is one decimal(38,0): 19
    digits of orderkey (any long), 3 of linenumber, 16 of the price in cents.
    A linenumber outside 0..999 or a price of 5e13 or more fails the query
    rather than being cut.
    """
    cents = _decimal(F.round(F.col("l_extendedprice") * F.lit(100.0)), 16)
    line = F.col("l_linenumber")
    fits = (line.isNull() | line.between(0, 999)) & (cents.isNull() | (F.abs(cents) < F.lit(5 * 10**15)))
    high = _decimal(_decimal(F.col("l_orderkey"), 19) * F.lit(1000) + line, 22)
    key = _decimal(high, 22) * _decimal(F.lit(str(10**16)), 17)
    order = F.when(fits, _decimal(_decimal(key, 38) + cents, 38)).otherwise(
        F.raise_error(F.lit("line number or price beyond the candle order key")).cast("decimal(38,0)")
    )
    agg = (
        lineitem.select(
            F.concat("l_returnflag", "l_linestatus", F.lit("USDT")).alias("symbol"),
            _day(F.col("l_shipdate")).alias("open_time"),
            F.col("l_extendedprice").alias("price"),
            F.col("l_quantity").cast("decimal(20,6)").alias("qty"),
            (
                F.col("l_extendedprice").cast("decimal(20,6)")
                * (F.lit(1) - F.col("l_discount").cast("decimal(12,8)")).cast("decimal(12,8)")
            ).alias("quote"),
            order.alias("ord"),
        )
        .groupBy("symbol", "open_time")
        .agg(
            F.min_by("price", "ord").alias("open"),
            F.max("price").alias("high"),
            F.min("price").alias("low"),
            F.max_by("price", "ord").alias("close"),
            F.sum("qty").cast("double").alias("volume"),
            F.sum("quote").cast("double").alias("quote_volume"),
            F.count(F.lit(1)).alias("trade_count"),
        )
    )
    return agg.select(
        "symbol",
        F.lit("1d").alias("interval"),
        F.col("open_time").cast("timestamp_ntz").alias("open_time"),
        "open",
        "high",
        "low",
        "close",
        "volume",
        _close_time("open_time", 86_400_000).cast("timestamp_ntz").alias("close_time"),
        "quote_volume",
        "trade_count",
    ).select(*CANDLE_COLUMNS)
