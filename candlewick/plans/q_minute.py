"""The heavy chain on one-minute candles, whose row count grows with ``events``
(hourly candles of the 30-day event stream stop growing at 3,600 rows)."""

from __future__ import annotations

from candlewick.operators import analytics as A
from candlewick.operators import quality as Q
from candlewick.plans import sql as S
from candlewick.operators import sampling as SM
from candlewick.plans import sql_clean as X
from candlewick.plans.q_clean import (
    SAMPLE_SEED,
    clean_sql_ctes,
    cleaned,
    dedup_key_spark,
    dedup_key_sql,
    messy,
    messy_sql_ctes,
)
from candlewick.plans.q_more import _report_sql, _sample_report_sql
from candlewick.plans.registry import as_dec, event_candles, query

M = "1m"
_SUMMARY_DEC = ["avg_volume", "avg_percent_change", "avg_price_range", "total_quote_volume"]


@query("candles_from_events_1m", S.with_ctes([("candles", S.candles_sql(M))], "SELECT * FROM candles"))
def q_candles_1m(spark, sf):
    return event_candles(spark, sf, M)


@query(
    "market_summary_1m",
    S.with_ctes(
        [("candles", S.candles_sql(M)), ("feat", S.features("candles")), ("agg", S.summary_agg("feat")),
         ("ranked", S.summary_ranked("agg"))],
        S.summary_select("ranked"),
    ),
)
def q_summary_1m(spark, sf):
    return as_dec(A.market_summary(event_candles(spark, sf, M)), _SUMMARY_DEC)


@query("inject_defects_1m", S.with_ctes(messy_sql_ctes(M), "SELECT * FROM messy"))
def q_messy_1m(spark, sf):
    return messy(spark, sf, M)


@query("clean_candles_1m", S.with_ctes(clean_sql_ctes(M), "SELECT * FROM cleaned"))
def q_clean_1m(spark, sf):
    return cleaned(spark, sf, M)


@query("quality_report_1m", _report_sql(clean_sql_ctes(M)))
def q_report_1m(spark, sf):
    return Q.quality_report(messy(spark, sf, M))


@query(
    "market_summary_cleaned_1m",
    S.with_ctes(
        clean_sql_ctes(M) + [("agg", S.summary_agg("cleaned")), ("ranked", S.summary_ranked("agg"))],
        S.summary_select("ranked", trades_type="DECIMAL(38,6)"),
    ),
)
def q_summary_cleaned_1m(spark, sf):
    return as_dec(A.market_summary(cleaned(spark, sf, M)), _SUMMARY_DEC + ["total_trades"])


_SAMPLE_1M = clean_sql_ctes(M) + X.sample_ctes("cleaned", 5, SAMPLE_SEED)


@query("stratified_sample_5_1m", S.with_ctes(_SAMPLE_1M, "SELECT * FROM sample"))
def q_sample_1m(spark, sf):
    return SM.stratified_sample(cleaned(spark, sf, M), n=5, seed=SAMPLE_SEED)


@query("sample_check_report_1m", _sample_report_sql(_SAMPLE_1M))
def q_sample_report_1m(spark, sf):
    return SM.sample_check_report(SM.stratified_sample(cleaned(spark, sf, M), n=5, seed=SAMPLE_SEED))


@query("dedup_by_candle_key_1m", dedup_key_sql(messy_sql_ctes(M)))
def q_dedup_key_1m(spark, sf):
    return dedup_key_spark(messy(spark, sf, M))


@query("kline_decode_1m", S.with_ctes([("candles", S.candles_sql(M))], "SELECT * FROM candles"))
def q_kline_1m(spark, sf):
    """Round trip through payloads of up to 1,440 one-minute candles per symbol-day."""
    from candlewick.sources.klines import candles_to_kline_json, decode_klines

    return decode_klines(candles_to_kline_json(event_candles(spark, sf, M)))
