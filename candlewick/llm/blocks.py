"""Documents in blocks: a table with one row per few megabytes of text.

A block is the unit that talks to the rest of the corpus: it asks for what it
needs by hash, and the answers come back keyed by block. Rows keep their input
partition (no shuffle to build the table); the payload is a compressed Arrow
stream, so moving a block costs less than moving its rows."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.llm.common import Scratch, tidy

NO_ID = (1 << 63) - 1


def payload_of(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def rows_of(payload: bytes) -> pa.RecordBatch:
    return pa.ipc.open_stream(payload).read_all().combine_chunks().to_batches()[0]


def texts_of(rows: pa.RecordBatch, column: str = "_text") -> list[bytes]:
    return [t or b"" for t in rows.column(column).cast(pa.binary()).to_pylist()]


def to_blocks(docs: DataFrame, scratch: Scratch, id_col: str, text_col: str, block_bytes: int, keep_rows: bool = False) -> DataFrame:
    """Table ``block, keys array<struct<doc_id, digest, n_bytes>>, payload``.

    A payload holds ``_id`` (the id as long), ``_text`` and, with ``keep_rows``,
    the columns of ``docs`` as ``c0, c1, ...`` (without a second copy of the
    text: its column is null there). ``digest`` is the MD5 of the text (null
    counts as empty)."""
    chosen = [F.col(id_col).cast("long").alias("_id"), F.col(text_col).cast("string").alias("_text")]
    if keep_rows:
        renamed = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
        at = docs.columns.index(text_col)
        chosen = [renamed[f"c{docs.columns.index(id_col)}"].cast("long").alias("_id"), renamed[f"c{at}"].cast("string").alias("_text")]
        chosen += [F.lit(None).cast("string").alias(c) if i == at else F.col(c) for i, c in enumerate(renamed.columns)]
        docs = renamed
    rows = docs.select(*chosen, F.md5(F.coalesce(chosen[1], F.lit("")).cast("binary")).alias("_digest"))

    def built(batches):
        from pyspark import TaskContext

        first = TaskContext.get().partitionId() << 32
        held, size, made = [], 0, 0

        def block():
            nonlocal held, size, made
            table = pa.Table.from_batches(held).combine_chunks()
            one = table.to_batches()[0]
            keys = [
                {"doc_id": i, "digest": bytes.fromhex(d), "n_bytes": n or 0}
                for i, d, n in zip(one.column("_id").to_pylist(), one.column("_digest").to_pylist(), pc.binary_length(one.column("_text")).to_pylist())
            ]
            payload = payload_of(one.drop_columns(["_digest"]))
            out = pa.RecordBatch.from_arrays(
                [pa.array([first + made], pa.int64()), pa.array([keys], key_type), pa.array([payload], pa.large_binary() if len(payload) > 1 << 30 else pa.binary())],
                ["block", "keys", "payload"],
            )
            held, size, made = [], 0, made + 1
            return out

        for batch in batches:
            lengths = pc.binary_length(batch.column("_text")).fill_null(0).to_pylist()
            since = 0
            for i, n in enumerate(lengths):
                size += n + 16
                if size >= block_bytes:
                    held.append(batch.slice(since, i + 1 - since))
                    since = i + 1
                    yield block()
            if since < batch.num_rows:
                held.append(batch.slice(since))
        if held:
            yield block()



    key_type = pa.list_(pa.struct([("doc_id", pa.int64()), ("digest", pa.binary()), ("n_bytes", pa.int64())]))
    schema = "block long, keys array<struct<doc_id: long, digest: binary, n_bytes: long>>, payload binary"
    return scratch.table(rows.mapInArrow(tidy(built), schema), codec="uncompressed")
