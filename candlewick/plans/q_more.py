"""Quality report, sampling, analytics over cleaned data, kline decoding and
trailing-window queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from candlewick.functions.exprs import epoch_ms_to_timestamp, ntz_epoch_micros
from candlewick.operators import analytics as A
from candlewick.operators import quality as Q
from candlewick.operators import sampling as SM
from candlewick.operators.windows import trailing_count
from candlewick.plans import sql as S
from candlewick.plans import sql_clean as X
from candlewick.plans.q_clean import CLEAN, MESSY, SAMPLE, SAMPLE_SEED, cleaned, messy
from candlewick.plans.registry import as_dec, event_candles, query
from candlewick.schema import CANDLE_COLUMNS, NUMERIC_COLUMNS, TIME_COLUMNS
from candlewick.sources.files import read_table
from candlewick.sources.klines import candles_to_kline_json, decode_klines, payload_fault
from candlewick.session import configure

_RAW = list(CANDLE_COLUMNS)
_CLEANED = _RAW + ["open_time__orig", "close_time__orig", "price_range", "price_change",
                   "percent_change", "candle_direction"]


def _qi(c: str) -> str:
    return '"interval"' if c == "interval" else c


def _report_sql(clean_ctes=None) -> str:
    rows = [
        "SELECT 0 AS seq, 'rows_before' AS metric, (SELECT count(*) FROM messy) AS value",
        "SELECT 1, 'rows_after', (SELECT count(*) FROM cleaned)",
    ]
    rows += [
        f"SELECT {100 + i}, 'missing_before:{c}', (SELECT count(*) - count({_qi(c)}) FROM messy)"
        for i, c in enumerate(_RAW)
    ]
    rows += [
        f"SELECT {200 + i}, 'missing_after:{c}', (SELECT count(*) - count({_qi(c)}) FROM cleaned)"
        for i, c in enumerate(_CLEANED)
    ]
    rows += [
        "SELECT 199, 'missing_before_total', (SELECT "
        + " + ".join(f"(count(*) - count({_qi(c)}))" for c in _RAW) + " FROM messy)",
        "SELECT 299, 'missing_after_total', (SELECT "
        + " + ".join(f"(count(*) - count({_qi(c)}))" for c in _CLEANED) + " FROM cleaned)",
    ]
    rows += [
        "SELECT 300, 'duplicates_before', (SELECT count(*) FROM c_typed) - (SELECT count(*) FROM c_dedup)",
        "SELECT 301, 'duplicates_after', (SELECT count(*) FROM cleaned) - "
        "(SELECT count(*) FROM (SELECT DISTINCT * FROM cleaned) d)",
        f"SELECT 302, 'rule_removed', (SELECT count_if({X.any_rule()}) FROM c_dedup)",
    ]
    rows += [
        f"SELECT {303 + i}, '{n}', (SELECT count_if({e}) FROM c_dedup)"
        for i, (n, e) in enumerate(X.RULES.items())
    ]
    numbers = [c for c in _RAW if c in NUMERIC_COLUMNS]
    bad = {c: f"({c} IS NOT NULL AND {X.safe_double(c)} IS NULL)" for c in numbers}
    bad |= {c: f"({c} IS NOT NULL AND {X.safe_ts(c)} IS NULL)" for c in TIME_COLUMNS}
    # the column order of the report follows NUMERIC_COLUMNS
    rows += [
        f"SELECT {410 + i}, 'unparsable:{c}', (SELECT count_if({bad[c]}) FROM messy)"
        for i, c in enumerate(n for n in NUMERIC_COLUMNS if n in numbers)
    ]
    rows += [f"SELECT {430 + i}, 'unparsable:{c}', (SELECT count_if({bad[c]}) FROM messy)" for i, c in enumerate(TIME_COLUMNS)]
    any_null = " OR ".join(f"{X.safe_double(c)} IS NULL" for c in numbers)
    respelled = f"coalesce(symbol <> {X.clean_symbol('symbol')}, false)"
    rows += [
        "SELECT 390, 'rule_hits', (SELECT " + " + ".join(f"count_if({e})" for e in X.RULES.values()) + " FROM c_dedup)",
        f"SELECT 400, 'invalid_numeric_rows', (SELECT count_if({any_null}) FROM messy)",
        f"SELECT 401, 'rows_repaired', (SELECT count_if({' OR '.join([respelled, *bad.values()])}) FROM messy)",
    ]
    body = " UNION ALL ".join(rows)
    return S.with_ctes(
        clean_ctes or CLEAN,
        f"SELECT CAST(seq AS INTEGER) AS seq, metric, CAST(value AS BIGINT) AS value FROM ({body}) r",
    )


@query("quality_report", _report_sql())
def q_report(spark, sf):
    return Q.quality_report(messy(spark, sf))


@query("quality_report_rechecked", _report_sql())
def q_report_recheck(spark, sf):
    """The same report over the dirty table read in another partitioning."""
    return Q.quality_report(messy(spark, sf).repartition(7, "symbol", "open_time"))


@query(
    "invalid_numbers",
    S.with_ctes(
        MESSY,
        " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS missing, "
            f"CAST(count_if({c} IS NOT NULL AND {X.safe_double(c)} IS NULL) AS BIGINT) AS unparsable, "
            f"CAST(count_if({X.safe_double(c)} IS NULL) AS BIGINT) AS invalid FROM messy"
            for c in _RAW
            if c in NUMERIC_COLUMNS
        ),
    ),
)
def q_invalid_numbers(spark, sf):
    return Q.invalid_numbers(messy(spark, sf))


# --- sampling -------------------------------------------------------------


def sample(spark, sf):
    return SM.stratified_sample(cleaned(spark, sf), n=5, seed=SAMPLE_SEED)


@query("stratified_sample_5", S.with_ctes(SAMPLE, "SELECT * FROM sample"))
def q_sample(spark, sf):
    return sample(spark, sf)


def _sample_report_sql(sample_ctes=None) -> str:
    w_order = "{'npr': -price_range, 's': symbol, 't': open_time}"
    L = SM.SAMPLE_REPORT_LABELS
    avg_close, top_volume, direction, w_symbol, w_time, w_range = (X.q(p) for p in SM.SAMPLE_REPORT_PREFIXES)
    heads = [
        "CAST((SELECT count(*) FROM sample) AS VARCHAR)",
        "CAST((SELECT count(DISTINCT symbol) FROM sample) AS VARCHAR)",
        "'5'",
        X.q(SM.SAMPLE_REPORT_QUESTIONS),
    ] + ["''"] * 4
    rows = [f"SELECT {seq} AS seq, {X.q(label)} AS metric, {value} AS value"
            for seq, label, value in zip(SM.HEAD_SEQ, L, heads)]
    rows += [
        f"SELECT 100, {avg_close} || symbol, CAST(CAST(avg(close) AS DECIMAL(38,6)) AS VARCHAR) "
        "FROM sample GROUP BY symbol",
        f"SELECT 201, {top_volume}, (SELECT arg_min(symbol, {{'nv': -v, 's': symbol}}) FROM "
        "(SELECT symbol, avg(volume) AS v FROM sample GROUP BY symbol) a WHERE v IS NOT NULL)",
        f"SELECT 301, {direction} || coalesce(candle_direction, {X.q(SM.SAMPLE_REPORT_NULL_LABEL)}), "
        "CAST(count(*) AS VARCHAR) FROM sample GROUP BY candle_direction",
        f"SELECT 401, {w_symbol}, (SELECT arg_min(symbol, {w_order}) FROM sample WHERE price_range IS NOT NULL)",
        f"SELECT 402, {w_time}, (SELECT {X.iso(f'arg_min(open_time, {w_order})')} FROM sample "
        "WHERE price_range IS NOT NULL)",
        f"SELECT 403, {w_range}, (SELECT CAST(CAST(arg_min(price_range, {w_order}) AS DECIMAL(38,6)) "
        "AS VARCHAR) FROM sample WHERE price_range IS NOT NULL)",
    ]
    body = " UNION ALL ".join(rows)
    return S.with_ctes(
        sample_ctes or SAMPLE, f"SELECT CAST(seq AS INTEGER) AS seq, metric, value FROM ({body}) r"
    )


@query("sample_check_report", _sample_report_sql())
def q_sample_report(spark, sf):
    return SM.sample_check_report(sample(spark, sf))


@query(
    "widest_range_row",
    S.with_ctes(
        CLEAN,
        "SELECT s.* FROM (SELECT arg_min({'symbol': symbol, 'open_time': open_time, 'price_range': price_range}, "
        "{'npr': -price_range, 's': symbol, 't': open_time}) AS s FROM cleaned WHERE price_range IS NOT NULL) w",
    ),
)
def q_widest(spark, sf):
    return SM.widest_range_row(cleaned(spark, sf))


@query(
    "top_symbol_by_avg_volume",
    S.with_ctes(
        CLEAN,
        "SELECT arg_min(symbol, {'nv': -v, 's': symbol}) AS symbol, CAST(max(v) AS DECIMAL(38,6)) AS avg_volume "
        "FROM (SELECT symbol, avg(volume) AS v FROM cleaned GROUP BY symbol) a WHERE v IS NOT NULL",
    ),
)
def q_top_volume(spark, sf):
    return as_dec(SM.top_symbol_by_avg_volume(cleaned(spark, sf)), ["avg_volume"])


@query(
    "distinct_symbols_raw",
    S.with_ctes(
        MESSY, "SELECT DISTINCT symbol FROM messy WHERE symbol IS NOT NULL"
    ),
)
def q_distinct_raw(spark, sf):
    return SM.distinct_symbols(messy(spark, sf))


@query(
    "distinct_symbols_clean",
    S.with_ctes(
        CLEAN, "SELECT DISTINCT symbol FROM cleaned WHERE symbol IS NOT NULL"
    ),
)
def q_distinct_clean(spark, sf):
    return SM.distinct_symbols(cleaned(spark, sf))


# --- analytics over the cleaned table (nulls present) ----------------------

_SUMMARY_DEC = ["avg_volume", "total_trades", "avg_percent_change", "avg_price_range", "total_quote_volume"]


@query(
    "market_summary_cleaned",
    S.with_ctes(
        CLEAN + [("agg", S.summary_agg("cleaned")), ("ranked", S.summary_ranked("agg"))],
        S.summary_select("ranked", trades_type="DECIMAL(38,6)"),
    ),
)
def q_summary_cleaned(spark, sf):
    return as_dec(A.market_summary(cleaned(spark, sf)), _SUMMARY_DEC)


def _busiest_clean_sql(period, expr, alias):
    return S.with_ctes(
        CLEAN + [("tf", S.time_features("cleaned"))],
        f"""SELECT {period}, CAST({alias} AS DECIMAL(38,6)) AS {alias} FROM (
  SELECT {period}, sum({expr}) AS {alias} FROM tf GROUP BY {period}
  ORDER BY {alias} DESC NULLS LAST, {period} ASC NULLS LAST LIMIT 1) b""",
    )


@query("busiest_date_quote_cleaned", _busiest_clean_sql("trade_date", "quote_volume", "total_quote_volume"))
def q_busiest_date_clean(spark, sf):
    return as_dec(A.busiest_period(cleaned(spark, sf), "date", "quote"), ["total_quote_volume"])


@query("busiest_hour_trades_cleaned", _busiest_clean_sql("trade_hour", "trade_count", "total_trades"))
def q_busiest_hour_clean(spark, sf):
    return as_dec(A.busiest_period(cleaned(spark, sf), "hour", "trades"), ["total_trades"])


@query(
    "date_quote_totals_cleaned",
    S.with_ctes(
        CLEAN + [("tf", S.time_features("cleaned"))],
        "SELECT trade_date, CAST(sum(quote_volume) AS DECIMAL(38,6)) AS total_quote_volume FROM tf GROUP BY trade_date",
    ),
)
def q_date_totals_clean(spark, sf):
    return as_dec(A.period_totals(cleaned(spark, sf), "date", "quote"), ["total_quote_volume"])


# --- kline payloads -------------------------------------------------------


@query("kline_decode", S.with_ctes([("candles", S.CANDLES)], "SELECT * FROM candles"))
def q_kline(spark, sf):
    payloads = candles_to_kline_json(event_candles(spark, sf))
    return decode_klines(payloads)


@query(
    "epoch_ms_to_timestamp",
    S.with_ctes(
        [("candles", S.CANDLES)],
        "SELECT symbol, epoch_ms(open_time) AS open_ms, epoch_ms(epoch_ms(open_time)) AS open_time, "
        "epoch_ms(close_time) AS close_ms, epoch_ms(epoch_ms(close_time)) AS close_time FROM candles",
    ),
)
def q_epoch(spark, sf):
    c = event_candles(spark, sf)
    ms = c.select(
        "symbol",
        F.floor(ntz_epoch_micros("open_time") / 1000).cast("bigint").alias("open_ms"),
        F.floor(ntz_epoch_micros("close_time") / 1000).cast("bigint").alias("close_ms"),
    )
    return ms.select(
        "symbol",
        "open_ms",
        epoch_ms_to_timestamp("open_ms").alias("open_time"),
        "close_ms",
        epoch_ms_to_timestamp("close_ms").alias("close_time"),
    )


# --- trailing windows -----------------------------------------------------

_TRAIL = "RANGE BETWEEN INTERVAL 59999999 MICROSECONDS PRECEDING AND CURRENT ROW"


@query(
    "trailing_60s_count",
    f"""SELECT event_id, user_id, ts,
       count(*) OVER (PARTITION BY user_id ORDER BY ts {_TRAIL}) AS trailing_count,
       count(*) OVER (PARTITION BY user_id ORDER BY ts {_TRAIL}) > 100 AS over_limit
FROM events""",
)
def q_trailing(spark, sf):
    configure(spark)
    ev = read_table(spark, sf, "events").select("event_id", "user_id", "ts")
    return trailing_count(ev, "ts", ["user_id"])


@query(
    "trailing_60s_global",
    f"""SELECT event_id, ts,
       count(*) OVER (ORDER BY ts {_TRAIL}) AS trailing_count,
       count(*) OVER (ORDER BY ts {_TRAIL}) > 100 AS over_limit
FROM events""",
)
def q_trailing_global(spark, sf):
    configure(spark)
    ev = read_table(spark, sf, "events").select("event_id", "ts")
    return trailing_count(ev, "ts", [])


# --- record count check ---------------------------------------------------


@query(
    "record_count_check",
    S.with_ctes(
        [("candles", S.CANDLES)],
        # decoded rows are counted from the events, not from the candles
        """SELECT symbol, direct_rows, decoded_rows, coalesce(direct_rows = decoded_rows, false) AS equal
FROM (SELECT symbol, count(*) AS direct_rows FROM candles GROUP BY symbol) a
FULL JOIN (SELECT upper(event_type) || 'USDT' AS symbol, count(DISTINCT date_trunc('hour', ts)) AS decoded_rows
           FROM events GROUP BY 1) b USING (symbol)""",
    ),
)
def q_count_check(spark, sf):
    """Candles per symbol built directly and through kline payloads must agree
    (the collector's serial-versus-threaded record count check)."""
    direct = event_candles(spark, sf)
    decoded = decode_klines(candles_to_kline_json(direct))
    a = direct.groupBy("symbol").agg(F.count(F.lit(1)).alias("direct_rows"))
    b = decoded.groupBy("symbol").agg(F.count(F.lit(1)).alias("decoded_rows"))
    return a.join(b, "symbol", "full").select(
        "symbol",
        "direct_rows",
        "decoded_rows",
        F.coalesce(F.col("direct_rows") == F.col("decoded_rows"), F.lit(False)).alias("equal"),
    )


@query(
    "expected_count_check",
    S.with_ctes(
        [("candles", S.CANDLES)],
        """SELECT symbol, count(*) AS n, (SELECT count(DISTINCT date_trunc('hour', ts)) FROM events) AS expected,
       count(*) = (SELECT count(DISTINCT date_trunc('hour', ts)) FROM events) AS ok
FROM candles GROUP BY symbol""",
    ),
)
def q_expected_count(spark, sf):
    """Rows per symbol against the records asked for: one per hour that the
    event stream covers (the collector's symbols x limit check)."""
    configure(spark)
    hours = read_table(spark, sf, "events").select(F.date_trunc("hour", F.col("ts").cast("timestamp")).alias("h")).distinct().count()
    return Q.count_check(event_candles(spark, sf), hours)


_AVERAGES = "count(*) AS {0}_rows, avg(close) AS {0}_c, avg(volume) AS {0}_v"


@query(
    "sample_against_full",
    S.with_ctes(
        SAMPLE,
        f"""SELECT symbol, full_rows, {S.dec('full_c', 'full_avg_close')}, {S.dec('full_v', 'full_avg_volume')},
       sample_rows, {S.dec('sample_c', 'sample_avg_close')}, {S.dec('sample_v', 'sample_avg_volume')}
FROM (SELECT symbol, {_AVERAGES.format('full')} FROM cleaned WHERE symbol IS NOT NULL GROUP BY symbol) f
LEFT JOIN (SELECT symbol, {_AVERAGES.format('sample')} FROM sample GROUP BY symbol) s USING (symbol)""",
    ),
)
def q_sample_full(spark, sf):
    full = cleaned(spark, sf)
    out = SM.sample_against_full(SM.stratified_sample(full, n=5, seed=SAMPLE_SEED), full)
    return as_dec(out, [c for c in out.columns if "_avg_" in c])


_PAYLOADS = """SELECT upper(event_type) || 'USDT' AS symbol, CAST(date_trunc('day', ts) AS DATE) AS day,
       count(DISTINCT date_trunc('hour', ts)) AS records, count(*) % 7 AS kind FROM events GROUP BY 1, 2"""


@query(
    "kline_decode_bad_payloads",
    f"""SELECT symbol, CAST(count_if(kind > 3) AS BIGINT) AS good_payloads,
       CAST(coalesce(sum(CASE WHEN kind > 3 THEN records END), 0) AS BIGINT) AS decoded_rows,
       CAST(count_if(kind <= 2) AS BIGINT) AS not_arrays, CAST(count_if(kind = 3) AS BIGINT) AS short_records
FROM ({_PAYLOADS}) p GROUP BY symbol""",
)
def q_bad_payloads(spark, sf):
    """Payloads of the event candles, three in seven kinds damaged by the day's
    event count: an error object, a cut-off array, garbage, a short record.
    Good ones decode, the others are reported, none vanishes."""
    candles = event_candles(spark, sf)
    counts = candles.groupBy("symbol", F.to_date("open_time").alias("day")).agg((F.sum("trade_count") % 7).alias("kind"))
    kind, value = F.col("kind"), F.col("value")
    broken = (
        F.when(kind == 0, F.lit('{"code":-1121,"msg":"Invalid symbol."}'))
        .when(kind == 1, F.substring(value, F.lit(1), (F.length(value) / 2).cast("int")))
        .when(kind == 2, F.lit("<html>busy</html>"))
        .when(kind == 3, F.lit('[[1,"2","3"]]'))
        .otherwise(value)
    )
    payloads = candles_to_kline_json(candles).join(counts, ["symbol", "day"]).withColumn("value", broken)
    decoded = decode_klines(payloads, on_bad="skip").groupBy("symbol").agg(F.count(F.lit(1)).alias("decoded_rows"))
    faults = payloads.withColumn("fault", payload_fault("value")).groupBy("symbol").agg(
        F.count_if(F.col("fault").isNull()).alias("good_payloads"),
        F.count_if(F.col("fault").startswith("not")).alias("not_arrays"),
        F.count_if(F.col("fault").startswith("record")).alias("short_records"),
    )
    return faults.join(decoded, "symbol", "left").select(
        "symbol", "good_payloads", F.coalesce("decoded_rows", F.lit(0)).cast("bigint").alias("decoded_rows"), "not_arrays", "short_records"
    )
