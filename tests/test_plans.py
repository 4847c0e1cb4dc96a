"""Plan-shape regression tests: the scale properties claimed in README."""

import re

import pytest
from pyspark.sql import functions as F

from candlewick.functions.picks import exact_picks
from candlewick.operators import analytics as A
from candlewick.operators import clean as CL
from candlewick.operators import sampling as SM
from candlewick.operators.windows import trailing_count
from candlewick.sources.adapters import candles_from_events
from candlewick.sources.files import read_table
from tests.conftest import SF001


def _plan(df, run: bool = False) -> str:
    """The physical plan; after execution (the final adaptive one) with ``run``."""
    if run:
        df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def no_broadcast(spark):
    """Plans as they are where no side is small enough to broadcast."""
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for k in keys:
        spark.conf.set(k, "-1")
    yield
    for k in keys:
        spark.conf.unset(k)


def _events(spark):
    return read_table(spark, SF001, "events")


def test_summary_aggregates_partially_and_prunes_columns(spark):
    plan = _plan(A.market_summary(candles_from_events(_events(spark))))
    # both the candle and the symbol aggregate combine map-side, as hash aggregates
    assert plan.count("partial_min_by") == 1 and "partial_count" in plan
    assert "SortAggregate" not in plan
    assert plan.count("Exchange hashpartitioning") == 2
    assert "Exchange SinglePartition" in plan  # ranks over the one-row-per-symbol result only
    scan = re.search(r"FileScan parquet \[([^\]]*)\]", plan).group(1)
    assert "user_id" not in scan  # column pruning reaches the scan


def test_sample_limits_rows_before_the_exchange(spark):
    lines = _plan(SM.stratified_sample(candles_from_events(_events(spark)), 5, 1)).splitlines()
    final = next(i for i, ln in enumerate(lines) if "WindowGroupLimit" in ln and "Final" in ln)
    partial = next(i for i, ln in enumerate(lines) if "WindowGroupLimit" in ln and "Partial" in ln)
    # tree order: Final limit, then the exchange, then the partial limit below it (map side)
    assert final < partial
    assert any("Exchange hashpartitioning(symbol" in ln for ln in lines[final:partial])


def test_exact_picks_do_not_join_or_shuffle_the_table(spark):
    df = spark.range(1000).select(F.format_string("u%d", "id").alias("_uid"))
    plan = _plan(exact_picks(df, "_uid", 1, {"a": (0.05, 1, 0)}))
    assert not re.search("Join|Exchange|Subquery|Aggregate", plan)


def test_key_dedup_and_full_dedup_combine_map_side(spark):
    typed = CL.coerce(spark.createDataFrame([("A", "1h", "2024-01-01T00:00:00Z", "1")] * 3,
                                            "symbol string, interval string, open_time string, open string"))
    assert "WindowGroupLimit" in _plan(CL.dedup_by_key(typed))
    lines = _plan(CL.dedup_rows(typed)).splitlines()
    ex = next(i for i, ln in enumerate(lines) if "Exchange" in ln)
    assert any("HashAggregate" in ln for ln in lines[ex + 1:])  # partial aggregate below the exchange


def _final(plan):
    return plan.split("== Initial Plan ==")[0]


def test_trailing_sweep_scans_and_shuffles_once(spark, no_broadcast):
    ev = _events(spark).select("event_id", "user_id", "ts")
    for options in ({}, {"range_rows": 50}):
        plan = _final(_plan(trailing_count(ev, "ts", ["user_id"], **options), run=True))
        assert "Join" not in plan and len(re.findall("FileScan parquet", plan)) == 1
        assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1
        assert "ArrowPython" not in plan and "InMemoryTableScan" not in plan


def test_key_dedup_forwards_a_row_per_key_and_task(spark, no_broadcast):
    rows = [(f"S{i}", "1h", "2024-01-01T00:00:00Z", "1") for i in range(50)] + [("S1", "1h", "2024-01-01T00:00:00Z", None)]
    typed = CL.coerce(spark.createDataFrame(rows, "symbol string, interval string, open_time string, open string"))
    out = CL.dedup_by_key(typed)
    plan = _final(_plan(out, run=True))
    assert "Join" not in plan and "SortAggregate" not in plan and len(re.findall("Exchange hashpartitioning", plan)) == 1
    below = plan[plan.index("Exchange hashpartitioning"):]
    assert "WindowGroupLimit" in below and len(re.findall("Scan ", plan)) == 1
    assert out.count() == 50 and out.where("symbol = 'S1' and open = 1").count() == 1


def test_order_keys_stay_in_hash_aggregates(spark):
    from candlewick.sources.adapters import candles_from_lineitem

    for candles in (candles_from_events(_events(spark)), candles_from_lineitem(read_table(spark, SF001, "lineitem"))):
        plan = _plan(candles)
        assert "HashAggregate" in plan and "SortAggregate" not in plan and "ObjectHashAggregate" not in plan


def test_report_scans_and_shuffles_the_raw_table_once(spark, tmp_dir):
    from candlewick.functions.text import candles_to_text
    from candlewick.operators.quality import quality_report

    candles_to_text(candles_from_events(_events(spark))).write.parquet(f"{tmp_dir}/text")
    plan = _final(_plan(quality_report(spark.read.parquet(f"{tmp_dir}/text")), run=True))
    assert len(re.findall(r"FileScan parquet", plan)) == 1
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1 and "SortAggregate" not in plan


def test_klines_are_parsed_once(spark):
    from candlewick.sources.klines import candles_to_kline_json, decode_klines

    payloads = candles_to_kline_json(candles_from_events(_events(spark)))
    optimized = decode_klines(payloads)._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"from_json\(", optimized)) == 1


def test_exact_aggregates_stay_in_hash_aggregates(spark):
    from candlewick.operators.analytics import market_summary

    plan = _plan(market_summary(candles_from_events(_events(spark))))
    assert "SortAggregate" not in plan and "ObjectHashAggregate" not in plan
