"""Cleaning of an all-text candle table.

Order (it decides every count): coerce numbers -> keep raw time text and
coerce times -> canonical symbols -> full-row de-duplication -> null-safe rule
filter -> derived columns. Rows whose values are missing are kept (a rule on a
null value is not a violation) unless ``strict=True``.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlewick.functions.exprs import clean_symbol, file_position, null_safe, safe_double, safe_timestamp
from candlewick.operators.analytics import derive_candle_features
from candlewick.schema import CANDLE_COLUMNS, NUMERIC_COLUMNS, TIME_COLUMNS

CANDLE_KEY = ("symbol", "interval", "open_time")
STRICT_REQUIRED = ("symbol", "open_time", "open", "high", "low", "close", "volume")


def coerce_numeric(df: DataFrame, columns: Sequence[str] = NUMERIC_COLUMNS) -> DataFrame:
    """Safe text -> double for every present numeric column."""
    return df.withColumns({c: safe_double(c) for c in columns if c in df.columns})


def coerce_times(df: DataFrame, columns: Sequence[str] = TIME_COLUMNS) -> DataFrame:
    """Keep the raw text as ``<c>__orig`` then parse ``c`` as UTC time."""
    present = [c for c in columns if c in df.columns]
    df = df.withColumns({f"{c}__orig": F.col(c) for c in present})
    return df.withColumns({c: safe_timestamp(c) for c in present})


def canonical_symbols(df: DataFrame) -> DataFrame:
    if "symbol" not in df.columns:
        return df
    return df.withColumn("symbol", clean_symbol("symbol"))


def coerce(df: DataFrame) -> DataFrame:
    """The three coercion steps, in order (one projection, no shuffle)."""
    return canonical_symbols(coerce_times(coerce_numeric(df)))


def dedup_rows(df: DataFrame) -> DataFrame:
    """Full-row de-duplication (null equals null). A hash aggregate that
    combines copies map-side, so a hot group of copies never reaches one task."""
    return df.dropDuplicates()


def null_count(columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a + b, [F.col(c).isNull().cast("int") for c in columns], F.lit(0))


def dedup_by_key(
    df: DataFrame, keys: Sequence[str] = CANDLE_KEY, tiebreak: Column | None = None
) -> DataFrame:
    """One row per candle key: the row with the fewest nulls, then the smallest
    ``tiebreak`` (default: md5 of the raw time texts and numbers).

    A ranked window that keeps the first row only: every map task forwards one
    row per key it has seen, so a key with any number of rows reaches one task
    as at most one row per map task. One scan, one shuffle.
    """
    value_cols = [c for c in df.columns if c not in keys]
    if tiebreak is None:
        tiebreak = F.md5(
            F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("\\N")) for c in value_cols])
        )
    best = Window.partitionBy(*keys).orderBy(null_count(df.columns), tiebreak)
    return df.withColumn("_rank", F.row_number().over(best)).where("_rank = 1").drop("_rank")


def duplicate_mask(df: DataFrame, position: Column | None = None, out: str = "is_duplicate") -> DataFrame:
    """``df`` with a mark on every row that is equal to an earlier one (null
    equals null); the first of equal rows is not marked.

    ``position`` orders the rows: a number, unique per row, the same whenever
    ``df`` is read (default: the place in its files). The first place of
    every repeated row comes from a hash aggregate that combines copies
    map-side; only repeated rows are on the other side of the join, so a large
    group of copies is one row there and its join partition can be split."""
    rows = df.withColumn("_at", (file_position(df) if position is None else position).cast("decimal(38,0)"))
    firsts = rows.groupBy(*df.columns).agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n")).where("_n > 1")
    names = {c: f"_d{i}" for i, c in enumerate(df.columns)}
    firsts = firsts.select(*[F.col(c).alias(n) for c, n in names.items()], "_first")
    same = reduce(lambda a, b: a & b, [rows[c].eqNullSafe(firsts[n]) for c, n in names.items()])
    mark = F.coalesce(F.col("_at") > F.col("_first"), F.lit(False))
    return rows.join(firsts, same, "left").select(*[rows[c] for c in df.columns], mark.alias(out))


def rule_columns(df: DataFrame, strict: bool = False) -> dict[str, Column]:
    """The row rules; each is true only when the row surely violates it."""
    rules: dict[str, Column] = {}
    if "volume" in df.columns:
        rules["negative_volume"] = null_safe(F.col("volume") < 0)
    if "trade_count" in df.columns:
        rules["negative_trade_count"] = null_safe(F.col("trade_count") < 0)
    if "high" in df.columns and "low" in df.columns:
        rules["high_lt_low"] = null_safe(F.col("high") < F.col("low"))
    if strict:
        for c in ("quote_volume", "taker_buy_base_volume", "taker_buy_quote_volume"):
            if c in df.columns:
                rules[f"negative_{c}"] = null_safe(F.col(c) < 0)
        req = [c for c in STRICT_REQUIRED if c in df.columns]
        rules["missing_required"] = reduce(or_, [F.col(c).isNull() for c in req], F.lit(False))
    return rules


def violates_any(df: DataFrame, strict: bool = False) -> Column:
    return reduce(or_, rule_columns(df, strict).values(), F.lit(False))


def rule_filter(df: DataFrame, strict: bool = False) -> DataFrame:
    """Drop rows that violate any rule; rows with nulls in rule columns stay."""
    return df.filter(~violates_any(df, strict))


def clean_candles(
    raw: DataFrame,
    *,
    strict: bool = False,
    dedup_keys: Sequence[str] | None = None,
) -> DataFrame:
    """Messy text candles -> cleaned candles (CLEANED_SCHEMA column order)."""
    typed = coerce(raw)
    deduped = dedup_by_key(typed, dedup_keys) if dedup_keys else dedup_rows(typed)
    kept = rule_filter(deduped, strict)
    out = derive_candle_features(kept)
    first = [c for c in CANDLE_COLUMNS if c in out.columns]
    rest = [c for c in out.columns if c not in first]
    return out.select(*first, *rest)
