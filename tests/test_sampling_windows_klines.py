"""Sampling, trailing windows, kline payloads, sinks."""

import json
import os

from pyspark.sql import Window
from pyspark.sql import functions as F

from candlewick.operators import sampling as SM
from candlewick.operators.windows import trailing_count
from candlewick.sources.adapters import candles_from_events
from candlewick.sources.files import read_cleaned_csv, read_table, write_csv, write_single_csv
from candlewick.sources.klines import candles_to_kline_json, decode_klines, read_klines
from tests.conftest import SF001, SF01


def test_stratified_sample_exact_and_partition_independent(spark):
    c = candles_from_events(read_table(spark, SF01, "events"))
    a = SM.stratified_sample(c.repartition(1), 5, 1)
    b = SM.stratified_sample(c.repartition(9), 5, 1)
    counts = {r["symbol"]: r["count"] for r in a.groupBy("symbol").count().collect()}
    assert counts and all(v == 5 for v in counts.values())
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_sample_of_small_group_keeps_all(spark):
    df = spark.createDataFrame([("A", i) for i in range(3)] + [("B", i) for i in range(9)], "symbol string, v int")
    out = SM.stratified_sample(df, 5, 1, uid=F.col("v").cast("string"))
    assert {r["symbol"]: r["count"] for r in out.groupBy("symbol").count().collect()} == {"A": 3, "B": 5}


def _brute(df, keys):
    w = Window.partitionBy(*keys).orderBy(F.unix_micros(F.col("ts").cast("timestamp"))).rangeBetween(-59_999_999, 0)
    return df.withColumn("want", F.count(F.lit(1)).over(w))


def test_trailing_count_matches_range_window(spark):
    ev = read_table(spark, SF01, "events").select("event_id", "user_id", "event_type", "ts")
    for keys in (["user_id"], ["event_type"], []):
        got = trailing_count(ev, "ts", keys)
        joined = got.join(_brute(ev, keys).select("event_id", "want"), "event_id")
        assert joined.count() == ev.count()
        assert joined.filter(F.col("trailing_count") != F.col("want")).count() == 0


def test_trailing_count_hot_instant_and_limit(spark):
    rows = [(i, "2024-01-01 00:00:30") for i in range(150)] + [(1000, "2024-01-01 00:01:29.999999"), (1001, "2024-01-01 00:01:30")]
    df = spark.createDataFrame(rows, "event_id long, t string").select(
        "event_id", F.col("t").cast("timestamp_ntz").alias("ts")
    )
    got = {r["event_id"]: (r["trailing_count"], r["over_limit"]) for r in trailing_count(df, "ts").collect()}
    assert got[0] == (150, True)
    assert got[1000] == (151, True)  # 59.999999 s after the burst: still inside
    assert got[1001] == (2, False)  # burst is 60 s back: outside; event 1000 inside


def test_one_kline_record(spark):
    payload = json.dumps([[1782838800000, "58497.65000000", "58618.65000000", "58334.01000000", "58374.01000000",
                           "500.34672000", 1782842399999, "29241831.01594340", 132566, "1.0", "2.0"]])
    df = spark.createDataFrame([("BTCUSDT", "1h", payload)], "symbol string, interval string, value string")
    r = decode_klines(df, with_taker=True).first()
    assert str(r["open_time"]) == "2026-06-30 17:00:00"
    assert str(r["close_time"]) == "2026-06-30 17:59:59.999000"
    assert r["open"] == 58497.65 and r["trade_count"] == 132566 and r["taker_buy_quote_volume"] == 2.0


def test_kline_files_round_trip(spark, tmp_dir):
    candles = candles_from_events(read_table(spark, SF001, "events"))
    payloads = candles_to_kline_json(candles).collect()  # test fixture only: write files
    for p in payloads:
        d = os.path.join(tmp_dir, f"symbol={p['symbol']}", f"interval={p['interval']}")
        os.makedirs(d, exist_ok=True)
        with open(os.path.join(d, f"{p['day']}.json"), "w") as f:
            f.write(p["value"])
    back = read_klines(spark, tmp_dir)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, candles.select(*back.columns).collect()))


def test_csv_sinks_round_trip(spark, tmp_dir):
    from candlewick.functions.text import candles_to_text
    from candlewick.operators.clean import clean_candles
    from candlewick.operators.analytics import market_summary

    cleaned = clean_candles(candles_to_text(candles_from_events(read_table(spark, SF001, "events"))))
    write_csv(cleaned, f"{tmp_dir}/cleaned")
    back = read_cleaned_csv(spark, f"{tmp_dir}/cleaned")
    assert back.count() == cleaned.count()
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, cleaned.collect()))
    inferred = read_cleaned_csv(spark, f"{tmp_dir}/cleaned", infer=True)
    assert inferred.count() == cleaned.count()
    assert dict(inferred.dtypes)["volume"] == "double"

    from candlewick.sources.files import read_candles_csv

    candles = candles_from_events(read_table(spark, SF001, "events"))
    write_csv(candles, f"{tmp_dir}/candles")
    assert sorted(map(tuple, read_candles_csv(spark, f"{tmp_dir}/candles").collect())) == sorted(
        map(tuple, candles.collect())
    )
    path = write_single_csv(market_summary(back), f"{tmp_dir}/spark_market_summary.csv")
    with open(path) as f:
        lines = f.read().strip().splitlines()
    assert lines[0].startswith("symbol,total_records,avg_volume")
    assert len(lines) == 6


def test_parquet_candles_prune_dates_and_columns(spark, tmp_dir):
    from candlewick.sources.files import read_candles_parquet, write_candles_parquet

    candles = candles_from_events(read_table(spark, SF01, "events"))
    write_candles_parquet(candles, f"{tmp_dir}/candles")
    back = read_candles_parquet(spark, f"{tmp_dir}/candles")
    q = back.filter(F.col("open_date") == F.lit("2024-01-05").cast("date")).select("symbol", "volume")
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(open_date" in plan
    assert "ReadSchema: struct<symbol:string,volume:double>" in plan
    want = candles.filter(F.to_date("open_time") == F.lit("2024-01-05").cast("date")).select("symbol", "volume")
    assert sorted(map(tuple, q.collect())) == sorted(map(tuple, want.collect()))
    assert back.count() == candles.count()
