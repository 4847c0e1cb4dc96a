"""Analytics queries: the reference's SQL statements and DataFrame reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from candlewick.operators import analytics as A
from candlewick.plans import sql as S
from candlewick.plans.registry import as_dec, event_candles, lineitem_candles, query

C = [("candles", S.CANDLES)]
CF = C + [("feat", S.features("candles"))]
CT = C + [("tf", S.time_features("candles"))]


@query("candles_from_events", S.with_ctes(C, "SELECT * FROM candles"))
def q_candles(spark, sf):
    return event_candles(spark, sf)


@query("candles_from_lineitem", S.with_ctes([("lc", S.LINEITEM_CANDLES)], "SELECT * FROM lc"))
def q_lineitem_candles(spark, sf):
    return lineitem_candles(spark, sf)


@query(
    "row_count_by_symbol",
    S.with_ctes(C, "SELECT symbol, count(*) AS total_rows FROM candles GROUP BY symbol"),
)
def q_row_count(spark, sf):
    return A.row_count_by_symbol(event_candles(spark, sf))


@query(
    "avg_close_by_symbol",
    S.with_ctes(
        C, f"SELECT symbol, {S.dec('avg(close)', 'avg_close_price')} FROM candles GROUP BY symbol"
    ),
)
def q_avg_close(spark, sf):
    return as_dec(A.avg_by_symbol(event_candles(spark, sf), "close", "avg_close_price"), ["avg_close_price"])


@query(
    "avg_volume_by_symbol",
    S.with_ctes(C, f"SELECT symbol, {S.dec('avg(volume)', 'avg_volume')} FROM candles GROUP BY symbol"),
)
def q_avg_volume(spark, sf):
    return as_dec(A.avg_by_symbol(event_candles(spark, sf), "volume", "avg_volume"), ["avg_volume"])


@query(
    "avg_percent_change_by_symbol",
    S.with_ctes(
        CF,
        f"SELECT symbol, {S.dec('avg(percent_change)', 'avg_percent_change')} FROM feat GROUP BY symbol",
    ),
)
def q_avg_pct(spark, sf):
    df = A.derive_candle_features(event_candles(spark, sf))
    return as_dec(A.avg_by_symbol(df, "percent_change", "avg_percent_change"), ["avg_percent_change"])


@query("derive_candle_features", S.with_ctes(CF, "SELECT * FROM feat"))
def q_features(spark, sf):
    return A.derive_candle_features(event_candles(spark, sf))


@query(
    "derive_time_features",
    S.with_ctes(CT, "SELECT symbol, open_time, trade_date, trade_hour, day_of_week FROM tf"),
)
def q_time_features(spark, sf):
    return A.derive_time_features(event_candles(spark, sf)).select(
        "symbol", "open_time", "trade_date", "trade_hour", "day_of_week"
    )


_VOL = f"""SELECT symbol, {S.dec('avg(price_range)', 'avg_price_range')},
       {S.dec('stddev_samp(price_range)', 'stddev_price_range')},
       min(price_range) AS min_price_range, max(price_range) AS max_price_range
FROM feat GROUP BY symbol"""


@query("volatility_stats", S.with_ctes(CF, _VOL))
def q_vol_stats(spark, sf):
    return as_dec(A.volatility_stats(event_candles(spark, sf)), ["avg_price_range", "stddev_price_range"])


@query(
    "volatility_ranking",
    S.with_ctes(
        CF,
        f"""SELECT symbol, {S.dec('a', 'avg_price_range')}, {S.dec('s', 'stddev_price_range')},
       mn AS min_price_range, mx AS max_price_range,
       CAST(row_number() OVER (ORDER BY a DESC NULLS LAST, s DESC NULLS LAST, symbol) AS INTEGER) AS rank
FROM (SELECT symbol, avg(price_range) a, stddev_samp(price_range) s, min(price_range) mn,
             max(price_range) mx FROM feat GROUP BY symbol) v""",
    ),
)
def q_vol_rank(spark, sf):
    return as_dec(A.volatility_ranking(event_candles(spark, sf)), ["avg_price_range", "stddev_price_range"])


@query(
    "activity_ranking",
    S.with_ctes(
        C,
        f"""SELECT symbol, CAST(t AS BIGINT) AS total_trades, {S.dec('q', 'total_quote_volume')},
       {S.dec('v', 'average_volume')},
       CAST(row_number() OVER (ORDER BY t DESC NULLS LAST, q DESC NULLS LAST, symbol) AS INTEGER) AS rank
FROM (SELECT symbol, sum(trade_count) t, sum(quote_volume) q, avg(volume) v
      FROM candles GROUP BY symbol) a""",
    ),
)
def q_act_rank(spark, sf):
    return as_dec(A.activity_ranking(event_candles(spark, sf)), ["total_quote_volume", "average_volume"])


def _busiest_sql(period: str, expr: str, alias: str, cast: str | None) -> str:
    total = f"CAST(sum({expr}) AS {cast})" if cast else f"sum({expr})"
    out = alias if cast else S.dec(alias, alias)
    return S.with_ctes(
        CT,
        f"""SELECT {period}, {out} FROM (
  SELECT {period}, {total} AS {alias} FROM tf GROUP BY {period}
  ORDER BY {alias} DESC NULLS LAST, {period} ASC NULLS LAST LIMIT 1) b""",
    )


def _busiest(by, metric, dec_col=None):
    def fn(spark, sf):
        out = A.busiest_period(event_candles(spark, sf), by, metric)
        return as_dec(out, [dec_col]) if dec_col else out

    return fn


query("busiest_hour_trades", _busiest_sql("trade_hour", "trade_count", "total_trades", "BIGINT"))(
    _busiest("hour", "trades")
)
query("busiest_hour_quote", _busiest_sql("trade_hour", "quote_volume", "total_quote_volume", None))(
    _busiest("hour", "quote", "total_quote_volume")
)
query("busiest_date_quote", _busiest_sql("trade_date", "quote_volume", "total_quote_volume", None))(
    _busiest("date", "quote", "total_quote_volume")
)
query("busiest_date_trades", _busiest_sql("trade_date", "trade_count", "total_trades", "BIGINT"))(
    _busiest("date", "trades")
)
query(
    "busiest_weekday_trades", _busiest_sql("day_of_week", "trade_count", "total_trades", "BIGINT")
)(_busiest("day_of_week", "trades"))


@query(
    "direction_value_counts",
    S.with_ctes(
        CF, "SELECT symbol, candle_direction, count(*) AS count FROM feat GROUP BY symbol, candle_direction"
    ),
)
def q_dir_counts(spark, sf):
    return A.direction_value_counts(event_candles(spark, sf))


@query(
    "direction_counts_pivot",
    S.with_ctes(
        CF,
        """SELECT symbol,
       CAST(count_if(candle_direction = 'up') AS BIGINT) AS up_candles,
       CAST(count_if(candle_direction = 'down') AS BIGINT) AS down_candles,
       CAST(count_if(candle_direction = 'flat') AS BIGINT) AS flat_candles
FROM feat GROUP BY symbol""",
    ),
)
def q_dir_pivot(spark, sf):
    return A.direction_counts(event_candles(spark, sf))


_SUMMARY_DEC = ["avg_volume", "avg_percent_change", "avg_price_range", "total_quote_volume"]
_SUMMARY_SQL = S.with_ctes(
    CF + [("agg", S.summary_agg("feat")), ("ranked", S.summary_ranked("agg"))],
    S.summary_select("ranked"),
)


@query("market_summary_fused", _SUMMARY_SQL)
def q_summary(spark, sf):
    return as_dec(A.market_summary(event_candles(spark, sf)), _SUMMARY_DEC)


@query("market_summary_joined", _SUMMARY_SQL)
def q_summary_joined(spark, sf):
    return as_dec(A.market_summary_joined(event_candles(spark, sf)), _SUMMARY_DEC)


@query(
    "market_summary_lineitem",
    S.with_ctes(
        [("lc", S.LINEITEM_CANDLES), ("feat", S.features("lc")), ("agg", S.summary_agg("feat")),
         ("ranked", S.summary_ranked("agg"))],
        S.summary_select("ranked", quote_scale=2),
    ),
)
def q_summary_lineitem(spark, sf):
    """Sums of ~1e9 quote volume carry ~1e-7 order noise: compared at 2 decimals."""
    out = as_dec(A.market_summary(lineitem_candles(spark, sf)), _SUMMARY_DEC[:3])
    return as_dec(out, ["total_quote_volume"], 2)


@query(
    "interpretation",
    S.with_ctes(
        CF + [("agg", S.summary_agg("feat")), ("ranked", S.summary_ranked("agg"))],
        f"""SELECT arg_min(symbol, activity_rank) AS top_activity_symbol,
       arg_min(symbol, volatility_rank) AS top_volatility_symbol,
       printf('{A.TOP_SYMBOLS_FORMAT}', arg_min(symbol, activity_rank),
              arg_min(symbol, volatility_rank)) AS message
FROM ranked""",
    ),
)
def q_interpretation(spark, sf):
    return A.interpretation(event_candles(spark, sf))


def _statement(name: str, decimals: tuple[str, ...] = ()):
    """A statement of the SQL surface over the market_data view."""

    def fn(spark, sf):
        A.register_market_data(event_candles(spark, sf))
        return as_dec(spark.sql(A.MARKET_DATA_SQL[name]), decimals)

    return fn


@query(
    "limit_10",
    S.with_ctes(CT, "SELECT count(*) AS n FROM (SELECT * FROM tf LIMIT 10) l"),
)
def q_limit(spark, sf):
    """Which ten rows the preview shows is undefined, so the comparable result
    is the number of rows returned."""
    return _statement("preview")(spark, sf).agg(F.count(F.lit(1)).alias("n"))


query(
    "sql_avg_close",
    S.with_ctes(C, f"SELECT symbol, {S.dec('avg(close)', 'avg_close_price')} FROM candles GROUP BY symbol"),
)(_statement("avg_close", ("avg_close_price",)))
query(
    "sql_avg_volume",
    S.with_ctes(C, f"SELECT symbol, {S.dec('avg(volume)', 'avg_volume')} FROM candles GROUP BY symbol"),
)(_statement("avg_volume", ("avg_volume",)))
query("sql_row_count", S.with_ctes(C, "SELECT symbol, count(*) AS total_rows FROM candles GROUP BY symbol"))(
    _statement("row_count")
)
query("sql_busiest_hour", _busiest_sql("trade_hour", "trade_count", "total_trades", "BIGINT"))(_statement("busiest_hour"))
query("sql_busiest_date", _busiest_sql("trade_date", "quote_volume", "total_quote_volume", None))(
    _statement("busiest_date", ("total_quote_volume",))
)


@query(
    "union_batches",
    S.with_ctes(
        C + [("lc", S.LINEITEM_CANDLES)],
        """SELECT symbol, "interval", count(*) AS total_rows, min(open_time) AS first_open,
       max(open_time) AS last_open
FROM (SELECT * FROM candles UNION ALL SELECT * FROM lc) u GROUP BY symbol, "interval\"""",
    ),
)
def q_union(spark, sf):
    both = event_candles(spark, sf).unionByName(lineitem_candles(spark, sf))
    return both.groupBy("symbol", "interval").agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.min("open_time").alias("first_open"),
        F.max("open_time").alias("last_open"),
    )
