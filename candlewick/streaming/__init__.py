"""Structured Streaming form of the kline ingest (same decoder as the batch reader)."""

from candlewick.streaming.klines import ingest_klines, ingest_rejects, stream_klines, stream_rejects

__all__ = ["ingest_klines", "ingest_rejects", "stream_klines", "stream_rejects"]
