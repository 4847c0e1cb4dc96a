"""Shared helpers: scratch tables in the cluster's checkpoint folder, sizing,
column selection and the word splitter used by several operators."""

from __future__ import annotations

import contextlib
import gc
import tempfile
import uuid
import warnings
import zlib
from contextvars import ContextVar

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words of every contract: runs of anything but ASCII white space.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_root(spark: SparkSession) -> str:
    """The shared folder of ``spark.checkpoint.dir``. Where the session names
    none, a temporary one is set on a single machine, with a warning; on a
    cluster that is an error."""
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        current = sc._jsc.sc().getCheckpointDir()
        if current.isDefined():
            root = current.get()
        else:
            if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
                raise RuntimeError("spark.checkpoint.dir is not set: executors need a shared folder")
            root = tempfile.mkdtemp(prefix="candlewick-llm-", dir="/tmp")
            warnings.warn(f"spark.checkpoint.dir is not set: scratch tables go to {root}", stacklevel=2)
            sc.setCheckpointDir(root)
    return root.rstrip("/")


#: Spark's setting for dropping a statement's shuffle files at its end.
FILE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Rows of a chunk (see ``Scratch.chunked``).
CHUNK = 4096
#: Scratch folders made in the open scopes, innermost last.
_SCOPES: ContextVar[tuple[list["Scratch"], ...]] = ContextVar("scratch_scopes", default=())


@contextlib.contextmanager
def scratch_scope():
    """Scratch folders that operators make inside the ``with`` block are
    deleted at its end. Results are lazy and read them, so they have to be
    written inside. Without a scope a folder stays until the application ends:
    nothing that a result may still read is ever deleted by another call."""
    made: list[Scratch] = []
    token = _SCOPES.set((*_SCOPES.get(), made))
    try:
        yield
    finally:
        _SCOPES.reset(token)
        for scratch in made:
            scratch.close()


class Scratch:
    """Tables written to the shared checkpoint folder.

    ``table`` cuts the lineage with a Parquet write, so a lost executor is
    answered by re-reading files. ``release`` lets Spark delete the shuffle
    files of plans that are no longer referenced; ``table`` does so first.
    ``drop`` deletes a table as soon as nothing reads it; what the returned
    result still reads goes at the end of the open ``scratch_scope`` or else
    of the application."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = f"{scratch_root(spark)}/llm-{uuid.uuid4().hex}"
        jvm = spark.sparkContext._jvm
        self._path = lambda p: jvm.org.apache.hadoop.fs.Path(p)
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = self._path(self.root).getFileSystem(conf)
        self._fs.deleteOnExit(self._path(self.root))
        self._n = 0
        scopes = _SCOPES.get()
        if scopes:
            scopes[-1].append(self)

    def table(self, df: DataFrame, codec: str = "zstd") -> DataFrame:
        self.release()
        path = f"{self.root}/t{self._n}"
        self._n += 1
        with self._shuffles_dropped():
            df.write.option("compression", codec).parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch_path = path
        return out

    @contextlib.contextmanager
    def _shuffles_dropped(self):
        """Shuffle files of what is written inside go when the write has ended
        (a lost executor's part is made again only while it runs)."""
        before = self.spark.conf.get(FILE_CLEANUP)
        self.spark.conf.set(FILE_CLEANUP, "true")
        try:
            yield
        finally:
            self.spark.conf.set(FILE_CLEANUP, before)

    def release(self) -> None:
        gc.collect()
        self.spark.sparkContext._jvm.System.gc()

    def chunked(self, df: DataFrame, codec: str = "zstd") -> DataFrame:
        """Table of ``df`` with a row number kept as ``_chunk`` and ``_bit``
        (CHUNK rows, one behind the other in a partition, share a chunk),
        bucketed by chunk: what is known per chunk joins it without moving
        these rows. Tasks write what they hold, so nothing is shuffled."""
        self.release()
        name, path = f"llm_{uuid.uuid4().hex}", f"{self.root}/t{self._n}"
        self._n += 1
        row = F.monotonically_increasing_id()
        rows = df.withColumn("_row", row).withColumns({"_chunk": F.floor(F.col("_row") / CHUNK), "_bit": (F.col("_row") % CHUNK).cast("int")}).drop("_row")
        buckets = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        try:  # only the catalog knows buckets: the name goes once the scan is resolved, the files stay
            with self._shuffles_dropped():
                rows.write.option("compression", codec).option("path", path).format("parquet").bucketBy(buckets, "_chunk").saveAsTable(name)
            out = self.spark.table(name)
            out.schema  # resolves it
        finally:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        out._scratch_path = path
        return out

    def drop(self, df: DataFrame) -> None:
        path = getattr(df, "_scratch_path", None)
        if path and path.startswith(f"{self.root}/"):
            self._fs.delete(self._path(path), True)
            df._scratch_path = None

    def close(self) -> None:
        """Delete all that is left, once nothing reads it any more."""
        place = self._path(self.root)
        self._fs.delete(place, True)
        self._fs.cancelDeleteOnExit(place)
        self.release()


def tidy(make):
    """A task function that hands its worker's unused memory back to the
    machine when the task ends: Spark keeps Python workers, and allocators
    keep what a worker once used."""

    def run(batches):
        yield from make(batches)
        import ctypes

        import pyarrow as pa

        gc.collect()
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
        if trim:
            trim(0)

    return run


def shards_for(spark: SparkSession, weight: float, per_shard: float) -> int:
    """Number of groups so that each holds about ``per_shard`` of ``weight``;
    at least the session's shuffle partitions, so small inputs spread too."""
    floor = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(1, floor, int(weight // per_shard) + 1)


def crc_mod(column: str, modulus: int):
    """crc32(column as text) mod ``modulus``; a null column counts as ''."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % modulus


def crc_mod_of(value, modulus: int) -> int:
    return zlib.crc32(b"" if value is None else str(value).encode()) % modulus


# ---------------------------------------------------------------- words

_C1, _C2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_S29, _S32 = np.uint64(29), np.uint64(32)
_TAIL = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [0xFFFFFFFFFFFFFFFF], dtype=np.uint64)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Words of more bytes are hashed one by one.
_LONG_WORD = 256


def mix(h: np.ndarray, value) -> np.ndarray:
    """One round of a 64-bit multiply-xor-shift hash."""
    h = (h ^ value) * _C1
    h = (h ^ (h >> _S32)) * _C2
    return h ^ (h >> _S29)


class Words:
    """The words of a batch of texts as arrays: ``start``/``end`` byte offsets
    in ``raw``, ``first`` (index of the first word of each text, with one more
    entry at the end) and 64-bit word hashes."""

    def __init__(self, texts: list[bytes], lower: bool):
        joined = b"\n".join(texts) + b"\n"
        size = len(joined)
        raw = np.frombuffer(joined + b"\0" * 8, dtype=np.uint8)
        if lower:
            raw = _LOWER[raw]
        space = _SPACE[raw[:size]]
        edge = np.flatnonzero(space[1:] != space[:-1]) + 1
        if size and not space[0]:
            edge = np.concatenate(([0], edge))
        self.raw, self.start, self.end = raw, edge[0::2], edge[1::2]
        length = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        text_start = np.concatenate(([0], np.cumsum(length + 1)))
        self.first = np.searchsorted(self.start, text_start)
        self._hash = None

    @property
    def hashes(self) -> np.ndarray:
        if self._hash is None:
            self._hash = self._hashed()
        return self._hash

    def _hashed(self) -> np.ndarray:
        start, length = self.start, self.end - self.start
        lanes = np.ndarray((len(self.raw) - 7,), dtype="<u8", buffer=self.raw.data, strides=(1,))
        h = mix(np.zeros(len(start), dtype=np.uint64), length.astype(np.uint64))
        at, left, some = start, np.minimum(length, _LONG_WORD), None
        while len(at):
            lane = lanes[at] & _TAIL[np.minimum(left, 8)]
            if some is None:
                h = mix(h, lane)
                some = np.arange(len(start))
            else:
                h[some] = mix(h[some], lane)
            more = left > 8
            some, at, left = some[more], at[more] + 8, left[more] - 8
        for i in np.flatnonzero(length > _LONG_WORD):
            import xxhash

            h[i] = xxhash.xxh64_intdigest(self.raw[start[i] : self.end[i]].tobytes(), 7)
        return h
