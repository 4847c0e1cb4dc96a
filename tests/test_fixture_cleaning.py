"""The 13-row messy fixture: every trap of the cleaning rules, in Spark."""

import math

import pytest
from pyspark.sql import functions as F

from candlewick.operators import analytics as A
from candlewick.operators import clean as CL
from candlewick.operators import quality as Q
from candlewick.sources.files import read_messy_csv
from tests.fixtures import write_messy


@pytest.fixture()
def raw(spark, tmp_dir):
    return read_messy_csv(spark, write_messy(tmp_dir), require_rows=True)


def _report(raw, **kw):
    return {r["metric"]: r["value"] for r in Q.quality_report(raw, **kw).collect()}


def test_missing_before_counts_only_empty_cells(raw):
    rows = {r["column"]: r["missing"] for r in Q.null_profile(raw).collect()}
    assert rows == {"volume": 1}


def test_invalid_numeric_rows(raw):
    # '', 'unknown' and '1d' (a Spark cast would accept '1d')
    assert Q.invalid_numeric_rows(raw).first()[0] == 3


def test_invalid_times(raw):
    got = {r["column"]: (r["missing"], r["unparsable"], r["invalid"]) for r in Q.invalid_timestamps(raw).collect()}
    assert got == {"open_time": (0, 2, 2), "close_time": (0, 0, 0)}


def test_duplicates_merge_padded_symbol_only(raw):
    assert Q.duplicate_count(raw).first()["duplicates"] == 1


def test_rule_counts(raw):
    typed = CL.dedup_rows(CL.coerce(raw))
    got = {r["metric"]: r["value"] for r in Q.rule_violation_counts(typed).collect()}
    assert got == {"negative_volume": 1, "negative_trade_count": 1, "high_lt_low": 1, "rule_hits": 3, "rows_removed": 3}


def test_clean_keeps_null_volume_rows(raw):
    cleaned = CL.clean_candles(raw)
    assert cleaned.count() == 9
    nulls = {r["column"]: r["missing"] for r in Q.null_counts(cleaned).collect()}
    assert nulls["open_time"] == 2
    assert nulls["open"] == 1
    assert nulls["volume"] == 2
    assert nulls["price_change"] == 1
    assert nulls["percent_change"] == 2
    assert nulls["candle_direction"] == 1
    assert nulls["open_time__orig"] == 0


def test_zero_open_gives_null_percent_but_direction(raw):
    cleaned = CL.clean_candles(raw)
    row = cleaned.filter((F.col("symbol") == "XRPUSDT") & (F.col("open") == 0)).first()
    assert row["percent_change"] is None
    assert row["candle_direction"] == "up"


def test_quality_report_invariants(raw):
    rep = _report(raw)
    assert rep["rows_before"] == 13
    assert rep["rows_after"] == 9
    assert rep["duplicates_before"] == 1
    assert rep["duplicates_after"] == 0
    assert rep["rule_removed"] == 3
    assert rep["rows_after"] == rep["rows_before"] - rep["duplicates_before"] - rep["rule_removed"]
    assert rep["missing_before:volume"] == 1
    assert rep["missing_after:volume"] == 2


def test_time_buckets_keep_null_group(raw):
    cleaned = CL.clean_candles(raw)
    hours = {r["trade_hour"]: r["total_trades"] for r in A.period_totals(cleaned, "hour", "trades").collect()}
    assert hours == {0: 89.0, 1: 72.0, None: 18.0}
    dates = {str(r["trade_date"]): r["total_quote_volume"] for r in A.period_totals(cleaned, "date", "quote").collect()}
    assert dates == {"2026-06-29": 3342.0, "None": 90.0}


def test_market_summary_on_fixture(raw):
    cleaned = CL.clean_candles(raw)
    rows = {r["symbol"]: r for r in A.market_summary(cleaned).collect()}
    btc, eth, sol, xrp, ada = (rows[s] for s in ["BTCUSDT", "ETHUSDT", "SOLUSDT", "XRPUSDT", "ADAUSDT"])
    assert btc["total_records"] == 2 and btc["avg_volume"] == 15 and btc["total_trades"] == 110
    assert math.isclose(btc["avg_percent_change"], 0.119048, abs_tol=1e-6)
    assert (btc["up_count"], btc["down_count"], btc["flat_count"]) == (1, 1, 0)
    assert eth["avg_volume"] is None and eth["total_quote_volume"] == 300
    assert math.isclose(sol["avg_volume"], 8.666667, abs_tol=1e-6)
    assert xrp["total_quote_volume"] == -4  # negative quote volume is kept
    assert ada["avg_percent_change"] == 100
    assert [rows[s]["volatility_rank"] for s in ["BTCUSDT", "ETHUSDT", "SOLUSDT", "XRPUSDT", "ADAUSDT"]] == [1, 2, 3, 4, 5]
    assert [rows[s]["activity_rank"] for s in ["BTCUSDT", "ETHUSDT", "SOLUSDT", "XRPUSDT", "ADAUSDT"]] == [1, 2, 3, 4, 5]


def test_joined_summary_equals_fused(raw):
    cleaned = CL.clean_candles(raw)
    fused = sorted(map(tuple, A.market_summary(cleaned).collect()))
    joined = sorted(map(tuple, A.market_summary_joined(cleaned).collect()))
    assert fused == joined


def test_strict_mode(raw):
    cleaned = CL.clean_candles(raw, strict=True)
    got = sorted((r["symbol"], str(r["open_time"])) for r in cleaned.collect())
    assert got == [
        ("BTCUSDT", "2026-06-29 00:00:00"),
        ("BTCUSDT", "2026-06-29 01:00:00"),
        ("XRPUSDT", "2026-06-29 00:00:00"),
    ]


def test_dedup_by_key_keeps_fewest_nulls(raw):
    typed = CL.coerce(raw)
    keyed = CL.dedup_by_key(typed)
    # the two SOLUSDT rows with unparsable open_time share the key (SOLUSDT, 1h, null)
    sol_null = keyed.filter((F.col("symbol") == "SOLUSDT") & F.col("open_time").isNull())
    assert sol_null.count() == 1
    assert keyed.count() == typed.select(*CL.CANDLE_KEY).distinct().count()


def test_render_report_text(raw):
    text = Q.render_report(Q.quality_report(raw))
    assert text.startswith("Data-quality report\nRows before cleaning: 13\nRows after cleaning: 9")
