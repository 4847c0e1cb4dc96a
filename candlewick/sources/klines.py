"""Kline JSON payloads: positional arrays of arrays -> candle rows.

A payload is the text of one exchange response: ``[[openMs, "o", "h", "l",
"c", "v", closeMs, "qv", n, "tbb", "tbq"], ...]``. Decoding is parallel by
payload (one file or one row each); nothing passes through the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.functions.exprs import epoch_ms_to_timestamp, ntz_epoch_micros, safe_double
from candlewick.functions.text import number_text
from candlewick.schema import CANDLE_COLUMNS, KLINE_FIELDS

_TIME_FIELDS = ("open_time", "close_time")
_RECORDS = "array<array<string>>"
_PARSED = f"lists array<{_RECORDS}>, broken string"


def parsed_payload(text: Column) -> Column:
    """One parse of a payload: ``lists`` (one, if the text is one list) and,
    where the text is not what it should be, ``broken`` (the parser's channel
    for corrupt records, so a text that is cut off is not taken in part)."""
    return F.from_json(F.concat(F.lit('{"lists":['), text, F.lit("]}")), _PARSED, {"columnNameOfCorruptRecord": "broken"})


def closed_text(text: Column) -> Column:
    """The text is one bracketed list, as far as its ends tell."""
    bare = F.trim(F.translate(text, "\n\r\t", "   "))
    return F.coalesce(bare.startswith("[") & bare.endswith("]"), F.lit(False))


def _records(parsed: Column) -> Column:
    return F.get(parsed["lists"], F.lit(0))


def _fault(parsed: Column, closed: Column) -> Column:
    records = _records(parsed)
    least = KLINE_FIELDS.index("trade_count") + 1
    short = F.exists(records, lambda r: r.isNull() | (F.size(r) < least))
    whole = (F.size(parsed["lists"]) == 1) & records.isNotNull() & parsed["broken"].isNull() & closed
    return F.when(~F.coalesce(whole, F.lit(False)), "not an array of records").when(short, "record with missing fields")


def payload_fault(payload) -> Column:
    """Why a payload can't be decoded, null for a good one: not an array of
    arrays (error objects, cut-off or other text, null) or a record with fewer
    fields than a candle has. An empty array is a good response without rows."""
    text = F.col(payload) if isinstance(payload, str) else payload
    return _fault(parsed_payload(text), closed_text(text))


def bad_payloads(df: DataFrame, payload: str = "value") -> DataFrame:
    """The rows of ``df`` that ``decode_klines`` refuses, with the ``fault``."""
    columns = df.columns
    parsed = df.withColumns({"_parsed": parsed_payload(F.col(payload)), "_closed": closed_text(F.col(payload))})
    return parsed.withColumn("fault", _fault(F.col("_parsed"), F.col("_closed"))).where("fault is not null").select(*columns, "fault")


def decode_klines(
    df: DataFrame,
    payload: str = "value",
    symbol="symbol",
    interval="interval",
    *,
    with_taker: bool = False,
    on_bad: str = "fail",
) -> DataFrame:
    """Explode JSON payloads into typed candles; a payload is parsed once.

    ``on_bad="fail"`` ends the query at the first payload with a fault;
    ``"skip"`` leaves such payloads out, to be reported by ``bad_payloads``.

    ``symbol`` / ``interval`` are column names (request parameters carried
    alongside each payload) or literal Columns. Numbers and quoted numbers
    both decode as text, then go through the safe casts.
    """
    sym = F.col(symbol) if isinstance(symbol, str) else symbol
    itv = F.col(interval) if isinstance(interval, str) else interval
    if on_bad not in ("fail", "skip"):
        raise ValueError(f"on_bad must be 'fail' or 'skip', not {on_bad!r}")
    text = F.col(payload)
    parsed = df.select(sym.alias("symbol"), itv.alias("interval"), parsed_payload(text).alias("_parsed"), closed_text(text).alias("_closed"))
    parsed = parsed.select("symbol", "interval", _records(F.col("_parsed")).alias("_records"), _fault(F.col("_parsed"), F.col("_closed")).alias("_fault"))
    said = F.concat(F.lit("bad kline payload for "), F.coalesce(F.col("symbol"), F.lit("?")), F.lit(": "), F.col("_fault"))
    bad = F.raise_error(said) if on_bad == "fail" else F.lit(None)
    records = parsed.select("symbol", "interval", F.explode(F.when(F.col("_fault").isNull(), F.col("_records")).otherwise(bad.cast(_RECORDS))).alias("rec"))
    fields = {}
    for i, name in enumerate(KLINE_FIELDS):
        raw = F.get("rec", F.lit(i))
        if name in _TIME_FIELDS:
            fields[name] = epoch_ms_to_timestamp(raw.try_cast("bigint"))
        elif name == "trade_count":
            fields[name] = raw.try_cast("bigint")
        else:
            fields[name] = safe_double(raw)
    cols = list(CANDLE_COLUMNS) + (
        ["taker_buy_base_volume", "taker_buy_quote_volume"] if with_taker else []
    )
    return records.select("symbol", "interval", *[fields[c].alias(c) for c in KLINE_FIELDS]).select(
        *cols
    )


def read_klines(spark: SparkSession, path: str, *, with_taker: bool = False, on_bad: str = "fail", lines: bool = False) -> DataFrame:
    """Read payload files laid out as ``.../symbol=XXX/interval=1h/*.json``;
    the directory names supply symbol and interval (partition discovery).

    A file is one response. With ``lines`` a file holds any number of
    responses, one per line (blank lines are left out), and is read in splits,
    so neither a row nor a task has to hold a file."""
    raw = spark.read.schema("value string, symbol string, interval string")  # no partition type inference
    raw = raw.text(path).where(F.trim("value") != "") if lines else raw.option("wholetext", True).text(path)
    return decode_klines(raw, "value", "symbol", "interval", with_taker=with_taker, on_bad=on_bad)


def candles_to_kline_json(candles: DataFrame) -> DataFrame:
    """Render candles as kline payloads, one per (symbol, interval, UTC day).

    A day holds at most 1,440 one-minute candles, so a payload row is bounded
    where candles are unique per (symbol, interval, open_time).
    Output: ``symbol, interval, day, value`` (JSON text).
    """
    rec = F.concat(
        F.lit("["),
        F.floor(ntz_epoch_micros("open_time") / 1000).cast("bigint").cast("string"),
        F.lit(',"'),
        number_text("open"),
        F.lit('","'),
        number_text("high"),
        F.lit('","'),
        number_text("low"),
        F.lit('","'),
        number_text("close"),
        F.lit('","'),
        number_text("volume"),
        F.lit('",'),
        F.floor(ntz_epoch_micros("close_time") / 1000).cast("bigint").cast("string"),
        F.lit(',"'),
        number_text("quote_volume"),
        F.lit('",'),
        F.col("trade_count").cast("bigint").cast("string"),
        F.lit(',"0","0"]'),
    )
    return (
        candles.select(
            "symbol",
            "interval",
            F.to_date("open_time").alias("day"),
            F.struct(F.col("open_time").alias("t"), rec.alias("r")).alias("rec"),
        )
        .groupBy("symbol", "interval", "day")
        .agg(F.array_sort(F.collect_list("rec")).alias("recs"))
        .select(
            "symbol",
            "interval",
            "day",
            F.concat(F.lit("["), F.array_join(F.col("recs.r"), ","), F.lit("]")).alias("value"),
        )
    )
