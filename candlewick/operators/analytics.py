"""Grouped analytics over a candle table: features, rankings, busiest periods,
direction pivot and the per-symbol market summary.

Ranks are ``row_number`` windows over per-symbol aggregates (one row per
symbol, so the unpartitioned window sorts #symbols rows, never detail rows).
Every rank ends with ``symbol`` so ties are broken the same way everywhere.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlewick.functions.exact import exact_avg, exact_stddev, exact_sum
from candlewick.functions.exprs import candle_direction, percent_change
from candlewick.schema import DERIVED_COLUMNS, DIRECTIONS, INTERPRETATION_FORMAT, require_columns
from candlewick.session import cut_lineage


def derive_candle_features(df: DataFrame) -> DataFrame:
    """price_range, price_change, percent_change (null on zero open), candle_direction."""
    require_columns(df, ["open", "high", "low", "close"])
    return df.withColumns(
        {
            "price_range": F.col("high") - F.col("low"),
            "price_change": F.col("close") - F.col("open"),
        }
    ).withColumns(
        {
            "percent_change": percent_change("price_change", "open"),
            "candle_direction": candle_direction("open", "close"),
        }
    )


def ensure_candle_features(df: DataFrame) -> DataFrame:
    """Derive the four feature columns unless all are present already."""
    if all(c in df.columns for c in DERIVED_COLUMNS):
        return df
    return derive_candle_features(df)


def derive_time_features(df: DataFrame, ts: str = "open_time") -> DataFrame:
    """trade_date, trade_hour, day_of_week ('Mon'...) of ``ts`` (UTC)."""
    require_columns(df, [ts])
    return df.withColumns(
        {
            "trade_date": F.to_date(ts),
            "trade_hour": F.hour(ts),
            "day_of_week": F.date_format(ts, "EEE"),
        }
    )


def _sum(df: DataFrame, c: str) -> Column:
    """Sum with the same bits for any partitioning (integers and decimals are exact as they are)."""
    return exact_sum(c) if dict(df.dtypes)[c] in ("double", "float") else F.sum(c)


def _avg(df: DataFrame, c: str) -> Column:
    return exact_avg(c) if dict(df.dtypes)[c] in ("double", "float") else F.avg(c)


def avg_by_symbol(df: DataFrame, column: str, alias: str) -> DataFrame:
    """``SELECT symbol, AVG(column) AS alias ... GROUP BY symbol ORDER BY symbol``."""
    return df.groupBy("symbol").agg(_avg(df, column).alias(alias)).orderBy("symbol")


def row_count_by_symbol(df: DataFrame) -> DataFrame:
    return df.groupBy("symbol").agg(F.count(F.lit(1)).alias("total_rows")).orderBy("symbol")


def _rank(order) -> F.Column:
    return F.row_number().over(Window.orderBy(*order))


def volatility_stats(df: DataFrame) -> DataFrame:
    """avg / sample stddev / min / max of price_range per symbol."""
    df = ensure_candle_features(df)
    return df.groupBy("symbol").agg(
        _avg(df, "price_range").alias("avg_price_range"),
        exact_stddev("price_range").alias("stddev_price_range"),
        F.min("price_range").alias("min_price_range"),
        F.max("price_range").alias("max_price_range"),
    )


def volatility_ranking(df: DataFrame) -> DataFrame:
    """Volatility stats plus ``rank`` (avg range desc, stddev desc, symbol)."""
    stats = volatility_stats(df)
    return stats.withColumn(
        "rank",
        _rank(
            [
                F.col("avg_price_range").desc_nulls_last(),
                F.col("stddev_price_range").desc_nulls_last(),
                F.col("symbol").asc_nulls_last(),
            ]
        ),
    )


def activity_stats(df: DataFrame) -> DataFrame:
    return df.groupBy("symbol").agg(
        _sum(df, "trade_count").alias("total_trades"),
        _sum(df, "quote_volume").alias("total_quote_volume"),
        _avg(df, "volume").alias("average_volume"),
    )


def activity_ranking(df: DataFrame) -> DataFrame:
    """Activity stats plus ``rank`` (total trades desc, quote volume desc, symbol)."""
    stats = activity_stats(df)
    return stats.withColumn(
        "rank",
        _rank(
            [
                F.col("total_trades").desc_nulls_last(),
                F.col("total_quote_volume").desc_nulls_last(),
                F.col("symbol").asc_nulls_last(),
            ]
        ),
    )


_PERIODS = {"hour": "trade_hour", "date": "trade_date", "day_of_week": "day_of_week"}
_METRICS = {"trades": ("trade_count", "total_trades"), "quote": ("quote_volume", "total_quote_volume")}


def period_totals(
    df: DataFrame, by: str = "hour", metric: str = "trades", drop_null_period: bool = False
) -> DataFrame:
    """Sum of a metric per period; the null period (unparsable time) is a group
    unless ``drop_null_period``."""
    period = _PERIODS.get(by, by)
    source, alias = _METRICS.get(metric, (metric, f"total_{metric}"))
    if period not in df.columns:
        df = derive_time_features(df)
    if drop_null_period:
        df = df.filter(F.col(period).isNotNull())
    return df.groupBy(period).agg(_sum(df, source).alias(alias))


def busiest_period(df: DataFrame, by: str = "hour", metric: str = "trades", n: int = 1) -> DataFrame:
    """Top-``n`` periods by the metric total (ties: earlier period first).

    Partial aggregation then ``TakeOrderedAndProject``: no global sort.
    """
    period = _PERIODS.get(by, by)
    _, alias = _METRICS.get(metric, (metric, f"total_{metric}"))
    totals = period_totals(df, by, metric)
    return totals.orderBy(F.col(alias).desc_nulls_last(), F.col(period).asc_nulls_last()).limit(n)


def direction_value_counts(df: DataFrame) -> DataFrame:
    """Rows per (symbol, candle_direction); a null direction is its own group."""
    df = ensure_candle_features(df)
    return df.groupBy("symbol", "candle_direction").agg(F.count(F.lit(1)).alias("count"))


def direction_counts(df: DataFrame) -> DataFrame:
    """Pivot of direction counts per symbol: up_candles, down_candles, flat_candles.

    Fixed pivot values, so no value-discovery job; missing cells are 0.
    """
    counts = direction_value_counts(df)
    return (
        counts.groupBy("symbol")
        .pivot("candle_direction", list(DIRECTIONS))
        .agg(F.sum("count"))
        .fillna(0, subset=list(DIRECTIONS))
        .withColumnsRenamed({d: f"{d}_candles" for d in DIRECTIONS})
    )


TOP_SYMBOLS_FORMAT = "Most active: %s. Most volatile: %s."

SUMMARY_COLUMNS = (
    "symbol",
    "total_records",
    "avg_volume",
    "total_trades",
    "avg_percent_change",
    "avg_price_range",
    "up_count",
    "down_count",
    "flat_count",
    "volatility_rank",
    "activity_rank",
    "total_quote_volume",
    "interpretation",
)


def _with_ranks_and_text(agg: DataFrame) -> DataFrame:
    ranked = agg.withColumns(
        {
            "volatility_rank": _rank(
                [
                    F.col("avg_price_range").desc_nulls_last(),
                    F.col("stddev_price_range").desc_nulls_last(),
                    F.col("symbol").asc_nulls_last(),
                ]
            ),
            "activity_rank": _rank(
                [
                    F.col("total_trades").desc_nulls_last(),
                    F.col("total_quote_volume").desc_nulls_last(),
                    F.col("symbol").asc_nulls_last(),
                ]
            ),
        }
    )
    return ranked.withColumn(
        "interpretation",
        F.format_string(INTERPRETATION_FORMAT, F.col("symbol"), F.col("volatility_rank")),
    )


def market_summary(df: DataFrame) -> DataFrame:
    """One row per symbol, ordered by activity rank (fused form).

    All per-symbol measures come from ONE ``groupBy("symbol")`` (one shuffle,
    map-side partial aggregation, so a hot symbol is combined before the
    exchange); the two ranks are windows over that one-row-per-symbol result.
    Rows with a null symbol are left out, as an inner join on symbol would.
    """
    df = ensure_candle_features(df).filter(F.col("symbol").isNotNull())
    direction = F.col("candle_direction")
    agg = df.groupBy("symbol").agg(
        F.count(F.lit(1)).alias("total_records"),
        _avg(df, "volume").alias("avg_volume"),
        _sum(df, "trade_count").alias("total_trades"),
        _avg(df, "percent_change").alias("avg_percent_change"),
        _avg(df, "price_range").alias("avg_price_range"),
        exact_stddev("price_range").alias("stddev_price_range"),
        F.count_if(direction == "up").alias("up_count"),
        F.count_if(direction == "down").alias("down_count"),
        F.count_if(direction == "flat").alias("flat_count"),
        _sum(df, "quote_volume").alias("total_quote_volume"),
    )
    return _with_ranks_and_text(agg).select(*SUMMARY_COLUMNS).orderBy("activity_rank")


def market_summary_joined(df: DataFrame) -> DataFrame:
    """The same summary built as five aggregates joined on symbol (inner).

    Kept to exercise the equi-join path and to show that it equals the fused
    form. The feature columns are written once, so the five aggregates (one
    shuffle of partial sums each, instead of one in all) read that table and
    the source is scanned once.
    """
    df = ensure_candle_features(df).select(
        "symbol", "volume", "trade_count", "quote_volume", *DERIVED_COLUMNS, "open", "high", "low", "close"
    )
    df = cut_lineage(df, without_folder="ignore")
    vol = volatility_ranking(df).select(
        "symbol", "avg_price_range", "stddev_price_range", F.col("rank").alias("volatility_rank")
    )
    act = activity_ranking(df).select(
        "symbol",
        "total_trades",
        "total_quote_volume",
        F.col("average_volume").alias("avg_volume"),
        F.col("rank").alias("activity_rank"),
    )
    rows = row_count_by_symbol(df).select("symbol", F.col("total_rows").alias("total_records"))
    pct = df.groupBy("symbol").agg(_avg(df, "percent_change").alias("avg_percent_change"))
    dirs = direction_counts(df).select(
        "symbol",
        F.col("up_candles").alias("up_count"),
        F.col("down_candles").alias("down_count"),
        F.col("flat_candles").alias("flat_count"),
    )
    joined = (
        vol.join(act, "symbol", "inner")
        .join(rows, "symbol", "inner")
        .join(pct, "symbol", "inner")
        .join(dirs, "symbol", "inner")
    )
    return joined.withColumn(
        "interpretation",
        F.format_string(INTERPRETATION_FORMAT, F.col("symbol"), F.col("volatility_rank")),
    ).select(*SUMMARY_COLUMNS).orderBy("activity_rank")


def interpretation(df: DataFrame) -> DataFrame:
    """Top activity and top volatility symbol, as a one-row DataFrame.

    ``min_by(symbol, rank)`` over the per-symbol summary: no driver collect.
    """
    summary = market_summary(df)
    return summary.agg(
        F.min_by("symbol", "activity_rank").alias("top_activity_symbol"),
        F.min_by("symbol", "volatility_rank").alias("top_volatility_symbol"),
    ).select(
        "top_activity_symbol",
        "top_volatility_symbol",
        F.format_string(
            TOP_SYMBOLS_FORMAT,
            F.col("top_activity_symbol"),
            F.col("top_volatility_symbol"),
        ).alias("message"),
    )


# The statements of the SQL surface (names and columns are its
# contract), over the view that ``register_market_data`` makes.
MARKET_DATA_SQL = {
    "preview": "SELECT * FROM market_data LIMIT 10",
    "avg_close": "SELECT symbol, avg(close) AS avg_close_price FROM market_data GROUP BY symbol ORDER BY symbol",
    "avg_volume": "SELECT symbol, avg(volume) AS avg_volume FROM market_data GROUP BY symbol ORDER BY symbol",
    "row_count": "SELECT symbol, count(*) AS total_rows FROM market_data GROUP BY symbol ORDER BY symbol",
    "busiest_hour": "SELECT trade_hour, sum(trade_count) AS total_trades FROM market_data "
    "GROUP BY trade_hour ORDER BY total_trades DESC, trade_hour LIMIT 1",
    "busiest_date": "SELECT trade_date, sum(quote_volume) AS total_quote_volume FROM market_data "
    "GROUP BY trade_date ORDER BY total_quote_volume DESC, trade_date LIMIT 1",
}


def register_market_data(df: DataFrame, name: str = "market_data") -> DataFrame:
    """Make ``df``, with the candle and time features it lacks, a temporary SQL
    view called ``name``; returns what the view shows."""
    out = ensure_candle_features(df)
    if "trade_hour" not in out.columns:
        out = derive_time_features(out)
    out.createOrReplaceTempView(name)
    return out
