"""Exact seeded picks and defect injection."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from candlewick.functions.exprs import row_hash
from candlewick.functions.picks import exact_picks
from candlewick.functions.text import candles_to_text
from candlewick.operators import clean as CL
from candlewick.operators import inject as I
from candlewick.operators import quality as Q
from candlewick.sources.adapters import candles_from_events
from candlewick.sources.files import read_table
from tests.conftest import SF01


def _uids(spark, n, parts):
    return spark.range(n).repartition(parts).select(F.format_string("row-%d", "id").alias("_uid"))


def test_pick_size_law_and_equals_global_rank(spark):
    df = _uids(spark, 10_000, 8)
    picked = exact_picks(df, "_uid", 42, {"drop": (0.03, 5, 1), "missing": (0.05, 10, 0)})
    got = picked.agg(F.count_if("_pick_drop"), F.count_if("_pick_missing")).first()
    assert tuple(got) == (300, 500)
    ranked = df.withColumn("r", F.row_number().over(Window.orderBy(row_hash(42, "drop", F.col("_uid")))))
    want = {r["_uid"] for r in ranked.filter("r <= 300").collect()}
    have = {r["_uid"] for r in picked.filter("_pick_drop").collect()}
    assert want == have


def test_pick_minimum_and_cap(spark):
    df = _uids(spark, 4, 2)
    picked = exact_picks(df, "_uid", 7, {"drop": (0.03, 5, 1), "dup": (0.03, 5, 0)})
    got = picked.agg(F.count_if("_pick_drop"), F.count_if("_pick_dup")).first()
    assert tuple(got) == (3, 4)  # min 5 capped at n-1 and at n


def test_picks_do_not_depend_on_partitioning(spark):
    a = exact_picks(_uids(spark, 5000, 1), "_uid", 3, {"x": (0.04, 8, 0)}).filter("_pick_x")
    b = exact_picks(_uids(spark, 5000, 13), "_uid", 3, {"x": (0.04, 8, 0)}).filter("_pick_x")
    assert sorted(r[0] for r in a.select("_uid").collect()) == sorted(r[0] for r in b.select("_uid").collect())


def test_size_law_10000_to_9991(spark):
    df = _uids(spark, 10_000, 8)
    dropped = I.drop_rows(df, 42)
    assert dropped.count() == 9_700
    assert I.duplicate_rows(dropped, 42).count() == 9_991


def _text(spark):
    return candles_to_text(candles_from_events(read_table(spark, SF01, "events")))


def test_injection_summary_and_round_trip(spark):
    text = _text(spark)
    summary = {r["metric"]: r["value"] for r in I.injection_summary(text, 42, symbols=None).collect()}
    n = summary["original_rows"]
    assert summary["dropped_rows"] == max(5, int(n * 0.03))
    kept = n - summary["dropped_rows"]
    assert summary["duplicated_rows"] == max(5, int(kept * 0.03))
    final = kept + summary["duplicated_rows"]
    assert summary["final_rows"] == final
    assert summary["missing_values"] == max(10, int(final * 0.05))
    assert summary["text_in_numeric_columns"] == max(8, int(final * 0.04))
    assert summary["invalid_times"] == max(6, int(final * 0.03))
    assert summary["inconsistent_symbols"] == max(8, int(final * 0.04))
    assert summary["negative_volumes"] == max(6, int(final * 0.03))

    messy = I.inject_defects(text, 42, symbols=None)
    assert messy.count() == final
    rep = {r["metric"]: r["value"] for r in Q.quality_report(messy).collect()}
    assert rep["rows_after"] == rep["rows_before"] - rep["duplicates_before"] - rep["rule_removed"]
    assert rep["duplicates_after"] == 0
    cleaned = CL.clean_candles(messy)
    assert cleaned.count() == rep["rows_after"]
    # every canonical symbol is one of the five event symbols again
    syms = {r[0] for r in cleaned.select("symbol").distinct().collect()}
    assert syms == {"CLICKUSDT", "ERRORUSDT", "PURCHASEUSDT", "SIGNUPUSDT", "VIEWUSDT"}


def test_injection_is_deterministic_across_partitionings(spark):
    text = _text(spark)
    a = I.inject_defects(text.repartition(1), 42, symbols=None)
    b = I.inject_defects(text.repartition(7), 42, symbols=None)
    assert sorted(map(tuple, a.collect()), key=repr) == sorted(map(tuple, b.collect()), key=repr)


def test_symbol_variants_only_for_known_symbols(spark):
    rows = [("BTCUSDT", "t1"), ("FOOBAR", "t2")] * 10
    df = spark.createDataFrame([(s, f"{t}-{i}") for i, (s, t) in enumerate(rows)], "symbol string, _uid string")
    out = I.inject_values(df, ["symbol"], 42, flags=True)
    hits = out.filter("_hit_symbol").select("symbol").collect()
    assert all(r[0] in ("btcusdt", " BTCUSDT ", "BTC/USDT") for r in hits)
    assert out.filter("_pick_symbol AND NOT _hit_symbol").count() + len(hits) == 8


def test_negative_volume_text(spark):
    df = spark.createDataFrame(
        [(f"u{i}", v, "5.5") for i, v in enumerate(["12.50000000", "abc", None, " 3 ", "-2"] * 4)],
        "_uid string, volume string, quote_volume string",
    )
    out = I.inject_values(df, ["negative"], 42, flags=True).filter("_pick_negative").collect()
    assert len(out) == 6
    for r in out:
        vals = [r["volume"], r["quote_volume"]]
        assert any(v is not None and (v == "-999" or v.startswith("-")) for v in vals)
