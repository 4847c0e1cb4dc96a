"""Column lists, schemas and fixed values of the candle data model."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# These must equal the original pipeline's for equal results.
# ---------------------------------------------------------------------------
# Known exchange symbols (collection list, also used by symbol-variant injection).
SYMBOLS = (
    "BTCUSDT",
    "ETHUSDT",
    "BNBUSDT",
    "SOLUSDT",
    "XRPUSDT",
    "ADAUSDT",
    "DOGEUSDT",
    "AVAXUSDT",
    "LINKUSDT",
    "DOTUSDT",
)
INTERVAL = "1h"
# Base candle columns, in file order.
CANDLE_COLUMNS = (
    "symbol",
    "interval",
    "open_time",
    "open",
    "high",
    "low",
    "close",
    "volume",
    "close_time",
    "quote_volume",
    "trade_count",
)
# Columns that a collector may add behind the base columns.
TAKER_COLUMNS = ("taker_buy_base_volume", "taker_buy_quote_volume")
# Numeric columns coerced by the cleaner (taker columns only when present).
NUMERIC_COLUMNS = (
    "open",
    "high",
    "low",
    "close",
    "volume",
    "quote_volume",
    "trade_count",
    "taker_buy_base_volume",
    "taker_buy_quote_volume",
)
# The defect injector knows the same numeric columns.
INJECT_NUMERIC_COLUMNS = NUMERIC_COLUMNS
TIME_COLUMNS = ("open_time", "close_time")
VOLUME_COLUMNS = ("volume", "quote_volume", "taker_buy_base_volume", "taker_buy_quote_volume")
# Replacement words used by the defect injector.
NUMERIC_TEXT_WORDS = ("not_available", "error", "missing", "unknown")
BAD_TIME_WORDS = ("not_a_date", "1900-99-99", "missing_time")
# Text that pandas' CSV reader turns into NaN by default.
NA_SENTINELS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)
# Positional layout of one kline record: index -> column.
KLINE_FIELDS = (
    "open_time",
    "open",
    "high",
    "low",
    "close",
    "volume",
    "close_time",
    "quote_volume",
    "trade_count",
    "taker_buy_base_volume",
    "taker_buy_quote_volume",
)
# Candle directions, in pivot order.
DIRECTIONS = ("up", "down", "flat")
# Sentence written per symbol into the market summary.
INTERPRETATION_FORMAT = "Activity: %s was active and ranked by volatility %d"
# Sample check report, in output order: the metric labels, then the per-row
# metric prefixes, the label of a missing direction and the questions line.
SAMPLE_REPORT_LABELS = (
    "Sample rows used",
    "Symbols included",
    "Records per symbol (target)",
    "Questions answered",
    "-- average close by symbol --",
    "-- highest average volume --",
    "-- candle direction counts --",
    "-- largest price range row --",
)
SAMPLE_REPORT_PREFIXES = ("avg_close_", "highest_avg_volume", "candle_", "symbol", "open_time", "price_range")
SAMPLE_REPORT_NULL_LABEL = "nan"
SAMPLE_REPORT_QUESTIONS = "average_close, highest_avg_volume, candle_direction_counts, largest_price_range_row"
# Data-quality text report, line by line ({} = value).
QUALITY_REPORT_LINES = (
    "Data-quality report",
    "Rows before cleaning: {}",
    "Rows after cleaning: {}",
    "Missing values before (per column):\n{}",
    "Missing values after (per column):\n{}",
    "Duplicate rows before: {}",
    "Duplicate rows after: {}",
    "Invalid numeric rows removed: {}",
    "Negative volume rows: {}",
    "Negative trade_count rows: {}",
    "Rows where high < low: {}",
    "Cleaning decision: {}",
)
# How the cleaning decision names a rule, and what the cleaner always does.
RULE_TEXTS = {
    "negative_volume": "a negative volume",
    "negative_trade_count": "a negative trade count",
    "high_lt_low": "a high below the low",
    "negative_quote_volume": "a negative quote volume",
    "negative_taker_buy_base_volume": "a negative taker base volume",
    "negative_taker_buy_quote_volume": "a negative taker quote volume",
    "missing_required": "a required value missing",
}
QUALITY_DECISION_REST = "numbers and times that cannot be read become null, symbols are spelled one way, equal rows are kept once."
# Request-rate limit of the collector: at most RATE_LIMIT requests per window.
RATE_LIMIT = 100
RATE_WINDOW_SECONDS = 60
# Per-step sizes of the defect injector: (fraction, minimum).
INJECT_SIZES = {
    "drop": (0.03, 5),
    "duplicate": (0.03, 5),
    "missing": (0.05, 10),
    "text": (0.04, 8),
    "bad_time": (0.03, 6),
    "symbol": (0.04, 8),
    "negative": (0.03, 6),
}
# ---------------------------------------------------------------------------

# Canonical candle table. Times are UTC wall-clock (timestamp_ntz), so hour and
# date never depend on the session time zone.
CANDLE_SCHEMA = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        T.StructField("interval", T.StringType()),
        T.StructField("open_time", T.TimestampNTZType()),
        T.StructField("open", T.DoubleType()),
        T.StructField("high", T.DoubleType()),
        T.StructField("low", T.DoubleType()),
        T.StructField("close", T.DoubleType()),
        T.StructField("volume", T.DoubleType()),
        T.StructField("close_time", T.TimestampNTZType()),
        T.StructField("quote_volume", T.DoubleType()),
        T.StructField("trade_count", T.LongType()),
    ]
)

# Raw text table: every column is a string.
MESSY_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in CANDLE_COLUMNS])

DERIVED_COLUMNS = ("price_range", "price_change", "percent_change", "candle_direction")

# Cleaned table: candle table with double trade counts (as the cleaner's float
# coercion leaves them), raw time texts and derived columns.
CLEANED_SCHEMA = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        T.StructField("interval", T.StringType()),
        T.StructField("open_time", T.TimestampNTZType()),
        T.StructField("open", T.DoubleType()),
        T.StructField("high", T.DoubleType()),
        T.StructField("low", T.DoubleType()),
        T.StructField("close", T.DoubleType()),
        T.StructField("volume", T.DoubleType()),
        T.StructField("close_time", T.TimestampNTZType()),
        T.StructField("quote_volume", T.DoubleType()),
        T.StructField("trade_count", T.DoubleType()),
        T.StructField("open_time__orig", T.StringType()),
        T.StructField("close_time__orig", T.StringType()),
        T.StructField("price_range", T.DoubleType()),
        T.StructField("price_change", T.DoubleType()),
        T.StructField("percent_change", T.DoubleType()),
        T.StructField("candle_direction", T.StringType()),
    ]
)


def require_columns(df, columns) -> None:
    """Raise ``ValueError`` naming every column of ``columns`` missing in ``df``."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {', '.join(missing)}")
