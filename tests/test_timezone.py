"""Library functions give the same answer whatever the session time zone."""

from pyspark.sql import functions as F

from candlewick.functions.exprs import safe_timestamp
from candlewick.functions.text import candles_to_text
from candlewick.operators.analytics import derive_time_features, market_summary
from candlewick.operators.windows import trailing_count
from candlewick.sources.adapters import candles_from_events
from candlewick.sources.files import read_table
from candlewick.sources.klines import candles_to_kline_json, decode_klines
from tests.conftest import SF001


def _run(spark):
    ev = read_table(spark, SF001, "events")
    candles = candles_from_events(ev, "1h")
    texts = spark.createDataFrame(
        [("2024-03-10T02:30:00+00:00",), ("2024-03-10T07:30:00+05:00",), ("2024-03-10 02:30:00",),
         ("2024-11-03T01:30:00Z",), ("2024-11-03T01:30:00.250000",)],
        "t string",
    )
    return {
        "candles": sorted(map(tuple, candles.collect())),
        "text": sorted(map(tuple, candles_to_text(candles).collect())),
        "time": sorted(map(tuple, derive_time_features(candles).select("trade_date", "trade_hour", "day_of_week").collect())),
        "summary": sorted(map(tuple, market_summary(candles).collect())),
        "parse": sorted(map(tuple, texts.select(safe_timestamp("t")).collect())),
        "klines": sorted(map(tuple, decode_klines(candles_to_kline_json(candles)).collect())),
        "trailing": sorted(map(tuple, trailing_count(ev.select("event_id", "user_id", "ts"), "ts", ["user_id"]).collect())),
    }


def test_results_do_not_depend_on_session_zone(spark):
    key = "spark.sql.session.timeZone"
    utc = _run(spark)
    try:
        spark.conf.set(key, "America/New_York")
        other = _run(spark)
    finally:
        spark.conf.set(key, "UTC")
    for part in utc:
        assert utc[part] == other[part], part
    parsed = [r[0] for r in utc["parse"]]
    assert str(parsed[0]) == "2024-03-10 02:30:00" and parsed.count(parsed[0]) == 3


def test_epoch_micros_of_a_dst_gap_wall_clock(spark):
    from candlewick.functions.exprs import epoch_ms_to_timestamp, ntz_epoch_micros

    key = "spark.sql.session.timeZone"
    try:
        spark.conf.set(key, "America/New_York")
        df = spark.createDataFrame([("2024-03-10 02:30:00.5",)], "t string").select(
            F.col("t").cast("timestamp_ntz").alias("ts")
        )
        r = df.select(ntz_epoch_micros("ts").alias("us"), epoch_ms_to_timestamp(F.lit(1710037800500)).alias("back")).first()
    finally:
        spark.conf.set(key, "UTC")
    assert r["us"] == 1710037800500000
    assert str(r["back"]) == "2024-03-10 02:30:00.500000"
