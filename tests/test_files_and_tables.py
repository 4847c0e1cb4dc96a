"""Malformed CSV rows, counted writes, and the lifetime of scratch tables."""

import os

import pytest
from pyspark import StorageLevel
from pyspark.sql import functions as F

from candlewick import cached, cut_lineage, table_scope
from candlewick.functions.text import candles_to_text
from candlewick.operators import inject as I
from candlewick.operators.analytics import market_summary, market_summary_joined
from candlewick.operators.sampling import sample_check_report, stratified_sample
from candlewick.operators.windows import trailing_count
from candlewick.session import checkpoint_dir
from candlewick.sources import candles_from_events, csv_reject_counts, csv_rejects, read_messy_csv, read_table, write_candles_parquet, write_csv
from tests.conftest import SF001
from tests.fixtures import MESSY_CSV

LINES = MESSY_CSV.splitlines()


@pytest.fixture()
def spoiled(tmp_dir):
    short, long = LINES[1].rsplit(",", 2)[0], LINES[2] + ",extra"
    quoted = LINES[3].replace("btc/usdt", '"btc,usdt"') + ',"a,b"'
    for name, rows in (("a.csv", [LINES[1], short, long]), ("b.csv", [quoted, LINES[4], LINES[5], short]), ("c.csv", [])):
        with open(os.path.join(tmp_dir, name), "w") as f:
            f.write("\n".join([LINES[0], *rows]) + "\n")
    return tmp_dir


def test_short_and_long_rows_are_reported(spark, spoiled):
    got = {(r["file"].rsplit("/", 1)[1], r["kind"], r["fields"]) for r in csv_rejects(spark, spoiled).collect()}
    assert got == {("a.csv", "short", 9), ("a.csv", "long", 12), ("b.csv", "long", 12), ("b.csv", "short", 9)}
    counts = {r["file"].rsplit("/", 1)[1]: tuple(r)[1:] for r in csv_reject_counts(spark, spoiled).collect()}
    assert counts == {"a.csv": (3, 1, 1, 0), "b.csv": (4, 1, 1, 0)}


def test_bad_rows_are_kept_dropped_or_end_the_query(spark, spoiled):
    assert read_messy_csv(spark, spoiled).count() == 7
    kept = read_messy_csv(spark, spoiled).where("symbol = 'BTCUSDT' and trade_count is null")
    assert kept.count() == 2
    assert read_messy_csv(spark, spoiled, bad_rows="drop").count() == 3
    with pytest.raises(Exception, match="fields: "):
        read_messy_csv(spark, spoiled, bad_rows="fail").select("volume").collect()
    with pytest.raises(ValueError, match="bad_rows"):
        read_messy_csv(spark, spoiled, bad_rows="ignore")


@pytest.mark.parametrize("write", [write_csv, write_candles_parquet])
def test_rows_are_counted_in_the_pass_that_writes_them(spark, tmp_dir, write):
    candles = candles_from_events(read_table(spark, SF001, "events"))
    n, path = candles.count(), os.path.join(tmp_dir, "out")
    scans = spark.sparkContext.accumulator(0)

    def read_once(batches):
        for b in batches:
            scans.add(b.num_rows)
            yield b

    write(candles.mapInArrow(read_once, candles.schema), path, expected=n)
    assert scans.value == n and spark.read.option("header", True).format("csv" if write is write_csv else "parquet").load(path).count() == n
    before = sorted(os.listdir(path))
    with pytest.raises(ValueError, match=f"{n - 1} rows, expected {n}"):
        write(candles.limit(n - 1), path, expected=n)
    assert sorted(os.listdir(path)) == before and os.listdir(tmp_dir) == ["out"]
    write(candles.where("false"), path, expected=0)
    assert os.listdir(tmp_dir) == ["out"]
    with pytest.raises(ValueError, match="mode"):
        write(candles, path, expected=n, mode="append")


def tables(spark):
    folder = os.path.join(checkpoint_dir(spark).removeprefix("file:"), "tables")
    return set(os.listdir(folder)) if os.path.isdir(folder) else set()


def test_no_table_is_left_behind(spark):
    before = tables(spark)
    candles = candles_from_events(read_table(spark, SF001, "events"))
    with table_scope(spark):
        joined = sorted(map(tuple, market_summary_joined(candles).collect()))
        report = sample_check_report(stratified_sample(candles.withColumn("open_time__orig", F.col("open_time").cast("string")), n=2)).collect()
        events = read_table(spark, SF001, "events").select("event_id", "user_id", "ts")
        assert trailing_count(events, "ts", ["user_id"]).count() == events.count()
        assert len(tables(spark) - before) == 3
    assert tables(spark) == before and report
    assert joined == sorted(map(tuple, market_summary(candles).collect()))
    summary = I.injection_summary(candles_to_text(candles), symbols=None)
    assert tables(spark) == before and summary.count() == 9


def test_a_failed_block_leaves_no_table_and_inner_scopes_end_first(spark):
    before = tables(spark)
    with pytest.raises(RuntimeError):
        with table_scope(spark):
            outer = cut_lineage(spark.range(5))
            with table_scope(spark):
                cut_lineage(spark.range(6))
            assert len(tables(spark) - before) == 1 and outer.count() == 5
            raise RuntimeError
    assert tables(spark) == before


def test_cached_holds_a_level_and_gives_it_back(spark):
    df = spark.range(100).withColumn("x", F.col("id") * 2)
    with cached(df, "MEMORY_AND_DISK_2") as held:
        assert held.storageLevel == StorageLevel.MEMORY_AND_DISK_2 and held.count() == 100
        assert "InMemoryTableScan" in held.groupBy().sum("x")._jdf.queryExecution().executedPlan().toString()
    assert df.storageLevel == StorageLevel.NONE
    with pytest.raises(ValueError, match="unknown storage level"):
        with cached(df, "SOMEWHERE"):
            pass
