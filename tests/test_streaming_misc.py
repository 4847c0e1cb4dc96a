"""Streaming ingest, registry contract, small helpers."""

import os

import pytest
from pyspark.sql import functions as F

from candlewick.operators import inject as I
from candlewick.operators import quality as Q
from candlewick.sources.adapters import candles_from_events
from candlewick.sources.files import read_table
from candlewick.sources.klines import candles_to_kline_json
from candlewick.streaming import ingest_klines
from tests.conftest import SF001


def test_streaming_ingest_matches_batch(spark, tmp_dir):
    candles = candles_from_events(read_table(spark, SF001, "events"))
    src = os.path.join(tmp_dir, "in")
    for p in candles_to_kline_json(candles).collect():  # fixture files only
        d = os.path.join(src, f"symbol={p['symbol']}", f"interval={p['interval']}")
        os.makedirs(d, exist_ok=True)
        with open(os.path.join(d, f"{p['day']}.json"), "w") as f:
            f.write(p["value"])
    q = ingest_klines(spark, src, os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "ckpt"))
    q.awaitTermination(120)
    out = spark.read.parquet(os.path.join(tmp_dir, "out"))
    assert out.count() == candles.count()
    got = sorted(map(tuple, out.select(*candles.columns).collect()))
    assert got == sorted(map(tuple, candles.collect()))


def test_missing_map_and_count_checks(spark):
    df = spark.createDataFrame([("A", None), ("A", 1), ("B", None)], "symbol string, v int")
    assert Q.missing_map(df).first()["missing"] == {"symbol": 0, "v": 2}
    checks = {r["symbol"]: r["ok"] for r in Q.count_check(df, 2).collect()}
    assert checks == {"A": True, "B": False}
    assert Q.expect_count(df, 3) == 3
    with pytest.raises(ValueError):
        Q.expect_count(df, 4)


def test_seeded_order_is_a_permutation(spark):
    df = spark.range(100).select(F.col("id").cast("string").alias("_uid"))
    a = [r[0] for r in I.seeded_order(df, 42).collect()]
    b = [r[0] for r in I.seeded_order(df.repartition(5), 42).collect()]
    assert a == b and sorted(a) == sorted(r[0] for r in df.collect()) and a != sorted(a)


def test_entry_and_registry_contract(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert df.count() == 5
    assert df.columns[:3] == ["symbol", "total_records", "avg_volume"]
    qs, sqls = E.queries(), E.oracle_sql()
    assert set(sqls) <= set(qs)
    assert len(qs) >= 60


def test_missing_input_raises(spark, tmp_dir):
    from pyspark.errors import AnalysisException

    from candlewick.sources.files import read_messy_csv

    with pytest.raises(AnalysisException):
        read_messy_csv(spark, os.path.join(tmp_dir, "nope.csv")).count()
    empty = os.path.join(tmp_dir, "empty.csv")
    with open(empty, "w") as f:
        f.write("symbol,interval,open_time,open,high,low,close,volume,close_time,quote_volume,trade_count\n")
    with pytest.raises(ValueError):
        read_messy_csv(spark, empty, require_rows=True)
