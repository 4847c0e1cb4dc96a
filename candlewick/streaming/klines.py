"""Kline payload files arriving in a folder, ingested with Structured Streaming.

The batch reader and the stream share ``decode_klines``; each micro-batch is
decoded and appended to a Parquet candle table. The checkpoint location makes
the ingest exactly-once across restarts (the file source tracks which files
it has seen; the Parquet sink commits per batch).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick.sources.klines import bad_payloads, decode_klines

_FILE_SCHEMA = T.StructType(
    [
        T.StructField("value", T.StringType()),
        T.StructField("symbol", T.StringType()),
        T.StructField("interval", T.StringType()),
    ]
)


def _files(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(_FILE_SCHEMA).option("wholetext", True)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.text(path)


def stream_klines(
    spark: SparkSession, path: str, *, max_files_per_trigger: int | None = None, on_bad: str = "fail"
) -> DataFrame:
    """Streaming candles from payload files under ``path/symbol=X/interval=Y/``;
    a bad payload ends the stream unless ``on_bad="skip"``."""
    raw = _files(spark, path, max_files_per_trigger)
    return decode_klines(raw, "value", "symbol", "interval", on_bad=on_bad)


def stream_rejects(spark: SparkSession, path: str, *, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming rows (file, symbol, interval, fault, payload text) of the
    payloads that ``stream_klines`` with ``on_bad="skip"`` leaves out."""
    raw = _files(spark, path, max_files_per_trigger).withColumn("file", F.col("_metadata.file_path"))
    return bad_payloads(raw).select("file", "symbol", "interval", "fault", "value")


def _started(query, once: bool):
    return (query.trigger(availableNow=True) if once else query.trigger(processingTime="1 minute")).start()


def ingest_rejects(spark: SparkSession, source: str, sink: str, checkpoint: str, *, once: bool = True):
    """Append refused payloads with their fault to the Parquet table at
    ``sink``: the counterpart of ``ingest_klines(..., on_bad="skip")`` over the
    same folder, with a checkpoint of its own, so no payload is lost unseen."""
    rows = stream_rejects(spark, source).writeStream.format("parquet").option("path", sink)
    return _started(rows.option("checkpointLocation", checkpoint).outputMode("append"), once)


def ingest_klines(
    spark: SparkSession,
    source: str,
    sink: str,
    checkpoint: str,
    *,
    once: bool = True,
    on_bad: str = "fail",
):
    """Append decoded candles to the Parquet table at ``sink``, partitioned by
    ``open_date`` like ``write_candles_parquet``. ``once=True`` processes what is there and stops (availableNow)."""
    query = (
        stream_klines(spark, source, on_bad=on_bad)
        .withColumn("open_date", F.to_date("open_time"))
        .writeStream.format("parquet")
        .option("path", sink)
        .option("checkpointLocation", checkpoint)
        .partitionBy("open_date")
        .outputMode("append")
    )
    return _started(query, once)
