"""Column -> Column building blocks (all JVM-side built-ins, no UDFs)."""

from candlewick.functions.exprs import (
    candle_direction,
    clean_symbol,
    epoch_ms_to_timestamp,
    hash_choice,
    hash_int,
    is_numeric_text,
    is_timestamp_text,
    null_safe,
    percent_change,
    row_hash,
    safe_double,
    safe_timestamp,
)

__all__ = [
    "candle_direction",
    "clean_symbol",
    "epoch_ms_to_timestamp",
    "hash_choice",
    "hash_int",
    "is_numeric_text",
    "is_timestamp_text",
    "null_safe",
    "percent_change",
    "row_hash",
    "safe_double",
    "safe_timestamp",
]
