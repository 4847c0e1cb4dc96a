"""Duplicate mask by input position; kline payloads: faults, lines, reject streams."""

import os

import pytest
from pyspark.sql import functions as F

from candlewick.functions.exprs import file_position
from candlewick.operators.clean import duplicate_mask
from candlewick.sources.klines import bad_payloads, decode_klines, read_klines
from candlewick.streaming import ingest_klines, ingest_rejects

GOOD = '[[1782838800000,"58497.65","58800","58000","58600.5","10.5",1782842399999,"615000.25",132566,"1.0","2.0"]]'


def test_mask_marks_all_but_the_first_in_file_order(spark, tmp_dir):
    for name, lines in (("b.csv", ["x,1", "y,2", "x,1"]), ("a.csv", ["y,2", "z,", "z,", "x,1"]), ("c.csv", ["x,1", "w,0"])):
        with open(os.path.join(tmp_dir, name), "w") as f:
            f.write("\n".join(lines) + "\n")
    df = spark.read.schema("s string, v string").csv(tmp_dir)
    rows = df.withColumn("at", file_position(df))
    masked = duplicate_mask(df, file_position(df))
    assert masked.columns == ["s", "v", "is_duplicate"]
    order = [r["s"] for r in rows.orderBy("at").collect()]
    assert order == ["y", "z", "z", "x", "x", "y", "x", "x", "w"]  # a, b, c
    counts = {(r["s"], r["is_duplicate"]): r["count"] for r in masked.groupBy("s", "is_duplicate").count().collect()}
    assert counts == {("x", False): 1, ("x", True): 3, ("y", False): 1, ("y", True): 1, ("z", False): 1, ("z", True): 1, ("w", False): 1}
    named = duplicate_mask(df.withColumn("file", F.input_file_name()).drop("file"))
    assert named.where("is_duplicate").count() == 5


def test_the_first_by_the_given_position_is_not_marked(spark):
    rows = [(i, "a" if i % 3 else None, 0.0 if i % 2 else -0.0) for i in range(12)] + [(99, "n", float("nan")), (98, "n", float("nan"))]
    df = spark.createDataFrame(rows, "i long, s string, v double").repartition(4)
    got = duplicate_mask(df.select("s", "v", "i"), F.col("i"))
    assert got.where("is_duplicate").count() == 0  # the position is part of the row here
    pairs = df.withColumn("again", F.explode(F.array(F.lit(0), F.lit(1)))).withColumn("place", F.col("i") * 2 + F.col("again"))
    marked = duplicate_mask(pairs.select("s", "v", "i", "place").drop("place"), F.col("i") * 2)
    assert marked.where("is_duplicate").count() == 0  # equal rows at one place: none is later than the other


def test_large_group_of_copies(spark):
    df = spark.range(5000).select(F.lit("same").alias("s"), F.lit(None).cast("int").alias("v"))
    masked = duplicate_mask(df)
    assert masked.where("NOT is_duplicate").count() == 1 and masked.count() == 5000


@pytest.mark.parametrize("text,fault", [
    (GOOD, None), ("[]", None), (" \n[] \r\n", None), (None, "not an array of records"), ("", "not an array of records"),
    ('{"code":-1121,"msg":"Invalid symbol."}', "not an array of records"), (GOOD[:-1], "not an array of records"), (GOOD[:60], "not an array of records"),
    (GOOD + "x", "not an array of records"), ("[1,2]", "not an array of records"), ('"[]"', "not an array of records"), ('[],"x":[1]', "not an array of records"),
    ("[[1,2,3]]", "record with missing fields"), ("[null]", "record with missing fields"),
])
def test_every_kind_of_payload(spark, text, fault):
    df = spark.createDataFrame([("S", "1h", text)], "symbol string, interval string, value string")
    assert [r["fault"] for r in bad_payloads(df).collect()] == ([] if fault is None else [fault])
    assert decode_klines(df, on_bad="skip").count() == (1 if text == GOOD else 0)
    if fault:
        with pytest.raises(Exception, match="bad kline payload for S"):
            decode_klines(df).collect()


def write(folder, symbol, name, text):
    at = os.path.join(folder, f"symbol={symbol}", "interval=1h")
    os.makedirs(at, exist_ok=True)
    with open(os.path.join(at, name), "w") as f:
        f.write(text)


def test_files_with_a_response_per_line(spark, tmp_dir):
    write(tmp_dir, "A", "many.json", f"{GOOD}\n\n[]\n{GOOD}\n")
    write(tmp_dir, "B", "one.json", GOOD)
    got = {r["symbol"]: r["count"] for r in read_klines(spark, tmp_dir, lines=True).groupBy("symbol").count().collect()}
    assert got == {"A": 2, "B": 1}


def test_stream_keeps_what_it_refuses(spark, tmp_dir):
    src = os.path.join(tmp_dir, "src")
    write(src, "A", "good.json", GOOD)
    write(src, "A", "bad.json", '{"code":1}')
    write(src, "B", "short.json", "[[1]]")
    ingest_klines(spark, src, f"{tmp_dir}/candles", f"{tmp_dir}/cp1", on_bad="skip").awaitTermination()
    ingest_rejects(spark, src, f"{tmp_dir}/rejects", f"{tmp_dir}/cp2").awaitTermination()
    assert spark.read.parquet(f"{tmp_dir}/candles").count() == 1
    rejects = {(r["symbol"], r["fault"], r["value"]) for r in spark.read.parquet(f"{tmp_dir}/rejects").collect()}
    assert rejects == {("A", "not an array of records", '{"code":1}'), ("B", "record with missing fields", "[[1]]")}
    write(src, "B", "later.json", "[1]")
    ingest_rejects(spark, src, f"{tmp_dir}/rejects", f"{tmp_dir}/cp2").awaitTermination()
    assert spark.read.parquet(f"{tmp_dir}/rejects").where("file LIKE '%later.json'").count() == 1
