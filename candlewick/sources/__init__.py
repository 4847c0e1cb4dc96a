"""Readers and writers for candle tables."""

from candlewick.sources.adapters import candles_from_events, candles_from_lineitem
from candlewick.sources.files import (
    csv_reject_counts,
    csv_rejects,
    read_candles_csv,
    read_candles_parquet,
    read_cleaned_csv,
    read_messy_csv,
    read_table,
    write_candles_parquet,
    write_csv,
    write_single_csv,
)
from candlewick.sources.klines import candles_to_kline_json, decode_klines, read_klines

__all__ = [
    "candles_from_events",
    "candles_from_lineitem",
    "candles_to_kline_json",
    "csv_reject_counts",
    "csv_rejects",
    "decode_klines",
    "read_candles_csv",
    "read_candles_parquet",
    "read_cleaned_csv",
    "read_klines",
    "read_messy_csv",
    "read_table",
    "write_candles_parquet",
    "write_csv",
    "write_single_csv",
]
