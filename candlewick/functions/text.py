"""Text forms of candle values, written the same way by Spark and DuckDB."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.functions.exprs import ntz_epoch_micros
from candlewick.schema import CANDLE_COLUMNS, TAKER_COLUMNS, TIME_COLUMNS


def iso_utc(c) -> Column:
    """UTC wall-clock timestamp -> '2026-06-29T00:00:00+00:00' (fraction only if non-zero)."""
    ts = F.col(c) if isinstance(c, str) else c
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    frac = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    whole_second = F.pmod(ntz_epoch_micros(ts.cast("timestamp_ntz")), F.lit(1_000_000)) == 0
    return F.concat(F.when(whole_second, whole).otherwise(frac), F.lit("+00:00"))


def number_text(c) -> Column:
    """Number -> fixed 8-decimal text ('58497.65000000') where that holds the
    value; other numbers (1e31, 1e-9) keep their shortest exact text."""
    col = F.col(c) if isinstance(c, str) else c
    fixed = col.try_cast("decimal(38,8)")
    whole = F.coalesce(fixed.cast("double") == col.cast("double"), F.lit(False))
    return F.when(whole, fixed.cast("string")).otherwise(col.cast("string"))


def candles_to_text(df: DataFrame) -> DataFrame:
    """Render a typed candle table as the all-text table a CSV export holds,
    with the taker columns when the table has them."""
    exprs = []
    for c in (*CANDLE_COLUMNS, *(t for t in TAKER_COLUMNS if t in df.columns)):
        if c in TIME_COLUMNS:
            exprs.append(iso_utc(c).alias(c))
        elif c == "trade_count":
            exprs.append(F.col(c).cast("bigint").cast("string").alias(c))
        elif c in ("symbol", "interval"):
            exprs.append(F.col(c))
        else:
            exprs.append(number_text(c).alias(c))
    return df.select(*exprs)


def text_uid(columns: Sequence[str] = ("symbol", "interval", "open_time")) -> Column:
    """Row identity from text columns: 'BTCUSDT|1h|2026-06-29T00:00:00+00:00'."""
    return F.concat_ws("|", *[F.coalesce(F.col(c), F.lit("\\N")) for c in columns])


def content_uid(df: DataFrame, columns: Sequence[str]) -> Column:
    """Row identity from typed columns: numbers as 8-decimal text, times as ISO text."""
    parts = []
    types = dict(df.dtypes)
    for c in columns:
        t = types[c]
        if t in ("double", "float") or t.startswith("decimal"):
            v = number_text(c)
        elif t.startswith("timestamp"):
            v = iso_utc(c)
        else:
            v = F.col(c).cast("string")
        parts.append(F.coalesce(v, F.lit("\\N")))
    return F.concat_ws("|", *parts)
