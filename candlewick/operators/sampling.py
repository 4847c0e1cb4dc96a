"""Exact per-group samples and the sample check report.

``stratified_sample`` keeps, per group, the ``n`` rows with the smallest
seeded hash: ``row_number() OVER (PARTITION BY g ORDER BY hash) <= n``.
Spark plans this filter as a partial ``WindowGroupLimit`` before the shuffle,
so each map task forwards at most ``n`` rows per group - a hot group is cut
down map-side and never lands whole in one task. The result is the same for
any partitioning (``rand()`` would not be).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlewick.functions.exact import exact_avg
from candlewick.functions.exprs import row_hash
from candlewick.functions.text import content_uid, iso_utc
from candlewick.operators.analytics import ensure_candle_features
from candlewick.schema import (
    CANDLE_COLUMNS,
    SAMPLE_REPORT_LABELS,
    SAMPLE_REPORT_NULL_LABEL,
    SAMPLE_REPORT_PREFIXES,
    SAMPLE_REPORT_QUESTIONS,
)

# Report layout: label i of SAMPLE_REPORT_LABELS goes to position HEAD_SEQ[i];
# per-row parts follow their heading (100, 201, 301, 401-403).
HEAD_SEQ = (1, 2, 3, 4, 5, 200, 300, 400)
AVG_CLOSE, TOP_VOLUME, DIRECTION, W_SYMBOL, W_TIME, W_RANGE = SAMPLE_REPORT_PREFIXES


def default_uid(df: DataFrame) -> Column:
    """Row identity from the raw time texts (if kept) and the candle values."""
    cols = [c for c in CANDLE_COLUMNS if c in df.columns]
    cols = [f"{c}__orig" if f"{c}__orig" in df.columns else c for c in cols]
    return content_uid(df, cols)


def stratified_sample(
    df: DataFrame, n: int = 5, seed: int = 1, by: str = "symbol", uid: Column | None = None
) -> DataFrame:
    """Exactly ``min(n, group size)`` rows per non-null group."""
    h = row_hash(seed, "sample", uid if uid is not None else default_uid(df))
    w = Window.partitionBy(by).orderBy(F.col("_h"))
    return (
        df.filter(F.col(by).isNotNull())
        .withColumn("_h", h)
        .withColumn("_rn", F.row_number().over(w))
        .filter(F.col("_rn") <= n)
        .drop("_h", "_rn")
    )


def _row(seq: int, metric: str, value: Column) -> Column:
    return F.struct(F.lit(seq).alias("seq"), F.lit(metric).alias("metric"), value.cast("string").alias("value"))


def _fmt6(c) -> Column:
    return F.col(c).cast("decimal(38,6)").cast("string") if isinstance(c, str) else c.cast("decimal(38,6)").cast("string")


def sample_check_report(sample: DataFrame, n: int = 5) -> DataFrame:
    """(seq, metric, value) report over a sample (bounded: n rows per symbol).

    The sample is materialised once (it is small) because five report parts
    read it; inside a ``table_scope`` that table goes at the scope's end."""
    from candlewick.session import cut_lineage

    sample = cut_lineage(ensure_candle_features(sample))
    head = sample.agg(
        F.count(F.lit(1)).cast("string").alias("rows"),
        F.count_distinct("symbol").cast("string").alias("symbols"),
    ).select(
        F.inline(
            F.array(
                *[
                    _row(seq, label, value)
                    for seq, label, value in zip(
                        HEAD_SEQ,
                        SAMPLE_REPORT_LABELS,
                        [F.col("rows"), F.col("symbols"), F.lit(str(n)), F.lit(SAMPLE_REPORT_QUESTIONS)]
                        + [F.lit("")] * 4,
                    )
                ],
            )
        )
    )
    by_symbol = sample.groupBy("symbol").agg(exact_avg("close").alias("c"), exact_avg("volume").alias("v"))
    avg_close = by_symbol.select(
        (F.lit(100)).alias("seq"),
        F.concat(F.lit(AVG_CLOSE), F.col("symbol")).alias("metric"),
        _fmt6("c").alias("value"),
    )
    top_volume = by_symbol.filter(F.col("v").isNotNull()).agg(
        F.min_by("symbol", F.struct((-F.col("v")).alias("nv"), F.col("symbol"))).alias("s")
    ).select(F.lit(201).alias("seq"), F.lit(TOP_VOLUME).alias("metric"), F.col("s").alias("value"))
    directions = sample.groupBy("candle_direction").agg(F.count(F.lit(1)).alias("n")).select(
        F.lit(301).alias("seq"),
        F.concat(F.lit(DIRECTION), F.coalesce(F.col("candle_direction"), F.lit(SAMPLE_REPORT_NULL_LABEL))).alias(
            "metric"
        ),
        F.col("n").cast("string").alias("value"),
    )
    time_col = "open_time"
    widest = sample.filter(F.col("price_range").isNotNull()).agg(
        F.min_by(
            F.struct("symbol", F.col(time_col).alias("t"), "price_range"),
            F.struct((-F.col("price_range")).alias("npr"), F.col("symbol"), F.col(time_col)),
        ).alias("w")
    )
    widest_rows = widest.select(
        F.inline(
            F.array(
                _row(401, W_SYMBOL, F.col("w.symbol")),
                _row(402, W_TIME, iso_utc(F.col("w.t"))),
                _row(403, W_RANGE, _fmt6(F.col("w.price_range"))),
            )
        )
    )
    return (
        head.unionByName(avg_close)
        .unionByName(top_volume)
        .unionByName(directions)
        .unionByName(widest_rows)
    )


def top_symbol_by_avg_volume(df: DataFrame) -> DataFrame:
    """Arg-max of the per-symbol average volume (ties: smaller symbol)."""
    avg = df.groupBy("symbol").agg(exact_avg("volume").alias("avg_volume")).filter(F.col("avg_volume").isNotNull())
    return avg.agg(
        F.min_by("symbol", F.struct((-F.col("avg_volume")).alias("nv"), F.col("symbol"))).alias("symbol"),
        F.max("avg_volume").alias("avg_volume"),
    )


def widest_range_row(df: DataFrame) -> DataFrame:
    """The row with the largest price range (ties: smaller symbol, earlier time)."""
    df = ensure_candle_features(df)
    return df.filter(F.col("price_range").isNotNull()).agg(
        F.min_by(
            F.struct("symbol", "open_time", "price_range"),
            F.struct((-F.col("price_range")).alias("npr"), F.col("symbol"), F.col("open_time")),
        ).alias("w")
    ).select("w.symbol", "w.open_time", "w.price_range")


def distinct_symbols(df: DataFrame, limit: int | None = None) -> DataFrame:
    """Distinct non-null symbols, in order; the first ``limit`` for a preview."""
    out = df.select("symbol").filter(F.col("symbol").isNotNull()).distinct().orderBy("symbol")
    return out if limit is None else out.limit(limit)


def sample_against_full(sample: DataFrame, full: DataFrame) -> DataFrame:
    """Per symbol: rows, average close and average volume of the sample beside
    those of all rows. Both sides are aggregated before the join."""

    def averages(df: DataFrame, side: str) -> DataFrame:
        return df.where("symbol is not null").groupBy("symbol").agg(
            F.count(F.lit(1)).alias(f"{side}_rows"),
            exact_avg("close").alias(f"{side}_avg_close"),
            exact_avg("volume").alias(f"{side}_avg_volume"),
        )

    return averages(full, "full").join(averages(sample, "sample"), "symbol", "left")
