"""Cases in which values used to be cut, lost or counted wrongly."""

import os

import pytest
from pyspark.sql import functions as F

from candlewick.functions.picks import pick_size
from candlewick.functions.text import candles_to_text, number_text
from candlewick.operators import analytics as A
from candlewick.operators import inject as I
from candlewick.operators import quality as Q
from candlewick.operators.clean import clean_candles
from candlewick.operators.windows import trailing_count
from candlewick.session import cut_lineage, drop_table, scale_settings
from candlewick.sources.adapters import candles_from_events, candles_from_lineitem
from candlewick.sources.files import read_candles_csv, read_cleaned_csv, read_messy_csv, write_single_csv
from candlewick.sources.klines import bad_payloads, decode_klines
from tests.fixtures import write_messy

EVENT = "event_id long, ts string, event_type string, value double, props string"


def events(spark, rows):
    df = spark.createDataFrame([(i, t, "x", v, '{"k": 1}') for i, t, v in rows], EVENT)
    return df.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@pytest.mark.parametrize("interval", ["1m", "1h", "1d"])
@pytest.mark.parametrize("bits", [26, 31, 37, 62])
def test_event_ids_order_in_full(spark, interval, bits):
    t = "2024-01-01 00:00:00"
    df = events(spark, [(2**bits - 1, t, 99.0), (2**bits, t, 10.0), (-5, "2024-01-01 00:00:01", 7.0)])
    r = candles_from_events(df, interval).first()
    assert (r["open"], r["close"]) == (99.0, 7.0)
    r = candles_from_events(df.where("event_id > 0"), interval).first()
    assert (r["open"], r["close"]) == (99.0, 10.0)


def test_event_sums_keep_small_parts(spark):
    t = "2024-01-01 00:00:00"
    assert candles_from_events(events(spark, [(1, t, 10.005), (2, t, 0.004)])).first()["volume"] == 10.009


def items(spark, rows):
    df = spark.createDataFrame([(*r, 1.0, 0.0, "A", "F", "1995-01-01") for r in rows],
                               "l_orderkey long, l_linenumber int, l_extendedprice double, l_quantity double, l_discount double, "
                               "l_returnflag string, l_linestatus string, d string")
    return df.withColumn("l_shipdate", F.col("d").cast("timestamp_ntz")).drop("d")


def test_lineitem_order_key_holds_every_part(spark):
    r = candles_from_lineitem(items(spark, [(1, 1, 10485.76), (1, 1, 10485.75)])).first()
    assert (r["open"], r["close"]) == (10485.75, 10485.76)
    big = 2**62
    r = candles_from_lineitem(items(spark, [(big + 1, 1, 5.0), (big, 7, 6.0), (2**40, 2, 7.0)])).first()
    assert (r["open"], r["close"]) == (7.0, 5.0)
    with pytest.raises(Exception, match="order key"):
        candles_from_lineitem(items(spark, [(1, 1000, 1.0)])).collect()


def test_number_text_keeps_values(spark):
    values = [1e31, 1e-9, 0.1, -2.5, 0.0, None, 123456789.12345678]
    out = spark.createDataFrame([(v,) for v in values], "v double").select("v", number_text("v").alias("t")).collect()
    assert [r["t"] for r in out][2:6] == ["0.10000000", "-2.50000000", "0.00000000", None]
    assert all(r["v"] is None or float(r["t"]) == r["v"] for r in out)


# ---------------------------------------------------------------- files

HEAD = "symbol,interval,open_time,open,high,low,close,volume,close_time,quote_volume,trade_count"


def save(folder, name, *lines):
    path = os.path.join(folder, name)
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")
    return path


@pytest.mark.parametrize("t", ["2026-06-29T01:00:00+00:00", "2026-06-29 01:00:00+00:00", "2026-06-29 01:00:00", "2026-06-29T03:00:00+02:00"])
def test_times_with_and_without_offset(spark, tmp_dir, t):
    path = save(tmp_dir, "a.csv", HEAD, f"BTCUSDT,1h,{t},1,2,0.5,1.5,10,{t},15,3")
    for reader in (read_candles_csv, read_cleaned_csv):
        r = reader(spark, path).first()
        assert str(r["open_time"]) == str(r["close_time"]) == "2026-06-29 01:00:00"
        assert r["trade_count"] == 3 and r["symbol"] == "BTCUSDT"


def test_columns_are_found_by_name(spark, tmp_dir):
    head = HEAD.split(",")
    values = dict(zip(head, "BTCUSDT,1h,2026-06-29T01:00:00Z,1,2,0.5,1.5,10,2026-06-29T01:59:59Z,15,3".split(",")))
    order = ["interval", "symbol", "taker_buy_base_volume", *reversed(head[2:]), "taker_buy_quote_volume", "note"]
    values |= {"taker_buy_base_volume": "4", "taker_buy_quote_volume": "-6", "note": "n"}
    path = save(tmp_dir, "b.csv", ",".join(order), ",".join(values[c] for c in order))
    raw = read_messy_csv(spark, path)
    r = raw.first()
    assert (r["symbol"], r["interval"], r["taker_buy_base_volume"], r["note"]) == ("BTCUSDT", "1h", "4", "n")
    typed = read_candles_csv(spark, path)
    assert dict(typed.dtypes)["taker_buy_quote_volume"] == "double" and typed.first()["open"] == 1.0
    assert "taker_buy_base_volume" in candles_to_text(typed).columns
    # the optional columns go through injection and cleaning
    assert clean_candles(raw).first()["taker_buy_base_volume"] == 4.0
    assert clean_candles(raw, strict=True).count() == 0
    assert "taker_buy_quote_volume" in I.inject_defects(raw.drop("note"), symbols=None).columns


def test_bad_files_are_refused(spark, tmp_dir):
    with pytest.raises(ValueError, match="open_time"):
        read_candles_csv(spark, save(tmp_dir, "c.csv", HEAD, "A,1h,nope,1,2,0.5,1.5,10,x,15,3"))
    with pytest.raises(ValueError, match="trade_count"):
        read_messy_csv(spark, save(tmp_dir, "d.csv", HEAD.rsplit(",", 1)[0], "A,1h,x,1,2,0.5,1.5,10,x,15"))


def test_single_csv_replaces_an_old_one(spark, tmp_dir):
    path = f"{tmp_dir}/one.csv"
    for n in (3, 2):
        write_single_csv(spark.range(n), path)
        with open(path) as f:
            assert len(f.read().split()) == n + 1
    assert sorted(x for x in os.listdir(tmp_dir) if not x.startswith(".")) == ["one.csv"]


# ---------------------------------------------------------------- payloads

GOOD = '[[1782838800000,"1","2","0.5","1.5","10",1782842399999,"15",3,"0","0"]]'
BAD = ['{"code":-1121,"msg":"Invalid symbol."}', GOOD[:30], "garbage", None, "", '[[1,"2"]]', GOOD + " x"]


def test_no_payload_vanishes(spark):
    rows = [(f"S{i}", "1h", p) for i, p in enumerate([GOOD, "[]", GOOD.replace("1782838800000", '"soon"'), *BAD])]
    df = spark.createDataFrame(rows, "symbol string, interval string, value string")
    assert {r["symbol"] for r in decode_klines(df, on_bad="skip").collect()} == {"S0", "S2"}
    assert {r["symbol"] for r in bad_payloads(df).collect()} == {f"S{i}" for i in range(3, 3 + len(BAD))}
    with pytest.raises(Exception, match="bad kline payload"):
        decode_klines(df).collect()
    with pytest.raises(ValueError):
        decode_klines(df, on_bad="maybe")


# ---------------------------------------------------------------- picks, windows, report


def test_picks_are_exact_where_candles_repeat(spark):
    rows = [(f"S{i // 50}", "1h", "t", str(i % 50 // 10)) for i in range(1000)]
    df = spark.createDataFrame(rows, "symbol string, interval string, open_time string, open string").repartition(7)
    named = I.with_unique_uid(df)
    assert named.count() == named.select(I.UID).distinct().count() == 1000
    assert I.drop_rows(named).count() == 1000 - pick_size(1000, 0.03, 5, 1) == 970
    again = I.drop_rows(I.with_unique_uid(df.repartition(3)))
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, I.drop_rows(named).collect()))


def test_injection_can_end_with_the_shuffle(spark):
    rows = [(f"S{i % 3}USDT", "1h", f"2024-01-01T{i % 24:02d}:00:00Z", str(i)) for i in range(60)]
    df = spark.createDataFrame(rows, "symbol string, interval string, open_time string, open string").dropDuplicates(["symbol", "open_time"])
    plain, mixed = I.inject_defects(df, symbols=None), I.inject_defects(df, symbols=None, shuffled=True)
    assert sorted(map(str, plain.collect())) == sorted(map(str, mixed.collect()))


def test_many_copies_of_one_row_get_numbers(spark):
    df = spark.range(25_000).select(F.lit("A").alias("symbol"), F.lit("1h").alias("interval"), F.lit("t").alias("open_time"))
    assert I.with_unique_uid(df).select(I.UID).distinct().count() == 25_000


def test_rows_without_time_have_no_count(spark):
    df = spark.createDataFrame([(1, None), (2, "1960-01-01 00:00:59.5"), (3, "1960-01-01 00:00:00.500001"), (4, None)], "id long, t string")
    df = df.select("id", F.col("t").cast("timestamp_ntz").alias("ts"))
    for window in (60_000_000, 59_000_001):  # the second isn't a multiple of the bucket count
        got = {r["id"]: r["trailing_count"] for r in trailing_count(df, "ts", window_us=window).collect()}
        assert got == {1: None, 4: None, 2: 2, 3: 1}


def test_report_follows_the_rules(spark, tmp_dir):
    raw = read_messy_csv(spark, write_messy(tmp_dir))
    plain = {r["metric"]: r["value"] for r in Q.quality_report(raw).collect()}
    assert plain["rule_hits"] == 3 and plain["duplicates_after"] == 0
    assert plain["invalid_numeric_rows"] == Q.invalid_numeric_rows(raw).first()[0]
    assert plain["unparsable:open_time"] == 2 and plain["rows_repaired"] >= 4
    strict = Q.quality_report(raw, strict=True)
    text = Q.render_report(strict)
    assert "a required value missing" in text and "a negative quote volume" in text
    assert "a required value missing" not in Q.render_report(Q.quality_report(raw))
    path = Q.write_report(strict, f"{tmp_dir}/report.txt")
    with open(path, encoding="utf-8") as f:
        assert f.read() == text + "\n"


def test_sql_surface(spark, tmp_dir):
    cleaned = clean_candles(read_messy_csv(spark, write_messy(tmp_dir)))
    view = A.register_market_data(cleaned)
    assert {"price_range", "trade_hour", "day_of_week"} <= set(view.columns)
    for statement in A.MARKET_DATA_SQL.values():
        assert spark.sql(statement).count() >= 1
    assert A.period_totals(cleaned, "hour", "trades", drop_null_period=True).where("trade_hour is null").count() == 0


def test_session_helpers(spark):
    kept = cut_lineage(spark.range(5))
    path = kept.inputFiles()[0].removeprefix("file://")
    assert kept.count() == 5 and os.path.exists(path)
    drop_table(kept)
    assert not os.path.exists(path)
    assert int(scale_settings(100 << 40, total_cores=8000)["spark.sql.shuffle.partitions"]) <= 20_000
    assert int(scale_settings(1 << 20, total_cores=8)["spark.sql.shuffle.partitions"]) == 8
