"""Session settings and lineage cuts."""

from __future__ import annotations

import os
import uuid
import warnings
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

_TZ = "spark.sql.session.timeZone"
_CHECKPOINT = "spark.checkpoint.dir"


def configure(spark: SparkSession) -> SparkSession:
    """Pin the session time zone to UTC (candle times are UTC) and enable AQE.

    Idempotent; only touches settings whose value differs.
    """
    if spark.conf.get(_TZ, None) != "UTC":
        spark.conf.set(_TZ, "UTC")
    if spark.conf.get("spark.sql.adaptive.enabled", "true") != "true":
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    return spark


#: Beyond this, shuffle blocks (map tasks x partitions) burden the driver more
#: than larger partitions burden the executors.
MAX_SHUFFLE_PARTITIONS = 20_000


def scale_settings(
    input_bytes: int,
    *,
    total_cores: int,
    shuffle_bytes: int | None = None,
    target_partition_bytes: int = 256 << 20,
    max_split_bytes: int = 256 << 20,
) -> dict[str, str]:
    """Shuffle and scan sizing.

    Partitions follow the bytes that are shuffled, about
    ``target_partition_bytes`` each and at least one wave over all cores, at
    most ``MAX_SHUFFLE_PARTITIONS``. ``shuffle_bytes`` defaults to a tenth of
    the input: candle aggregates combine map-side, so their exchanges carry
    far less than the scan. AQE coalesces small partitions and splits skewed ones.
    """
    moved = shuffle_bytes if shuffle_bytes is not None else input_bytes // 10
    partitions = min(MAX_SHUFFLE_PARTITIONS, max(total_cores, -(-moved // target_partition_bytes)))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(max_split_bytes),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes // 2),
        "spark.sql.adaptive.skewJoin.enabled": "true",
    }


def apply_scale_settings(spark: SparkSession, input_bytes: int, total_cores: int) -> dict[str, str]:
    conf = scale_settings(input_bytes, total_cores=total_cores)
    for k, v in conf.items():
        spark.conf.set(k, v)
    return conf


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder the cluster names, if any."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get(_CHECKPOINT, None) or sc.getConf().get(_CHECKPOINT, None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    return None


def ensure_test_checkpoint_dir(spark: SparkSession, fallback: str) -> None:
    """Tests only: set a checkpoint folder when the session names none."""
    if checkpoint_dir(spark) is None:
        os.makedirs(fallback, exist_ok=True)
        spark.sparkContext.setCheckpointDir(fallback)


def cut_lineage(df: DataFrame, *, without_folder: str = "warn") -> DataFrame:
    """Write ``df`` as a Parquet table in the shared checkpoint folder and
    return a scan of it.

    Used between multi-pass stages: later passes read the columnar table
    (with column pruning) instead of recomputing the plan, and a lost executor
    re-reads files instead of re-running the lineage. One write job, unlike
    ``Dataset.checkpoint``, which computes an unpersisted plan twice. Without a
    configured folder the plan is recomputed by every pass: ``without_folder``
    says whether to "warn", "fail" or "ignore". Tables are deleted at the end
    of the ``table_scope`` they are written in, by ``drop_table``, or when the
    application ends.
    """
    spark = df.sparkSession
    root = checkpoint_dir(spark)
    if root is None:
        if without_folder == "fail":
            raise RuntimeError(f"{_CHECKPOINT} is not set")
        if without_folder == "warn":
            warnings.warn(f"{_CHECKPOINT} is not set: multi-pass stages recompute their input", stacklevel=2)
        return df
    path = scratch_path(spark, root)
    df.write.mode("overwrite").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._table_path = path
    return out


def scratch_path(spark: SparkSession, root: str) -> str:
    """A new path below the shared folder ``root``. What is written there is
    deleted at the end of the open ``table_scope``, else with the application."""
    path = f"{root.rstrip('/')}/tables/{uuid.uuid4().hex}"
    fs, place = _place(spark, path)
    fs.deleteOnExit(place)  # as the path is made, so that a failed write leaves nothing either
    scopes = _SCOPES.get()
    if scopes:
        scopes[-1].append(path)
    return path


#: Paths of the tables written in the open scopes, innermost last.
_SCOPES: ContextVar[tuple[list[str], ...]] = ContextVar("table_scopes", default=())


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def _delete(spark: SparkSession, path: str) -> None:
    fs, place = _place(spark, path)
    fs.delete(place, True)
    fs.cancelDeleteOnExit(place)


def drop_table(df: DataFrame) -> None:
    """Delete the table behind a ``cut_lineage`` result that nothing reads any more."""
    path = getattr(df, "_table_path", None)
    if path:
        _delete(df.sparkSession, path)
        df._table_path = None


@contextmanager
def table_scope(spark: SparkSession) -> Iterator[None]:
    """Tables that operators write for themselves inside the ``with`` block are
    deleted at its end, whatever happens. Results that read them (DataFrames
    are lazy) have to be written or collected inside. Scopes may be nested;
    a table belongs to the innermost one."""
    paths: list[str] = []
    token = _SCOPES.set((*_SCOPES.get(), paths))
    try:
        yield
    finally:
        _SCOPES.reset(token)
        for path in paths:
            _delete(spark, path)


@contextmanager
def cached(df: DataFrame, level: str = "MEMORY_AND_DISK") -> Iterator[DataFrame]:
    """``df`` persisted at the storage level of that name ("DISK_ONLY",
    "MEMORY_AND_DISK_2", ...) inside the ``with`` block, and given back at its
    end. For what fits the executors; a lost executor's part is computed again
    from its lineage. Larger intermediate results go to ``cut_lineage``."""
    kind = getattr(StorageLevel, level, None)
    if not isinstance(kind, StorageLevel):
        raise ValueError(f"unknown storage level {level!r}")
    held = df.persist(kind)
    try:
        yield held
    finally:
        held.unpersist()
