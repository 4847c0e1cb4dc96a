"""Token counts: heap-and-linked-list byte-pair merging.

The lowest-rank adjacent pair is popped and merged until none is left; the
count of a word is its initial symbols minus its merges, no ids are made."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.llm.pretoken import ByteBpe, Splitter, heap_merge, worker_held


def counter(tokenizer_path: str) -> Splitter:
    vocab = ByteBpe(tokenizer_path)
    byte_id, ranks, new_ids = vocab.byte_ids.__getitem__, vocab.ranks, vocab.new_ids

    def count(piece: bytes) -> int:
        return len(piece) - heap_merge(list(map(byte_id, piece)), ranks, new_ids)

    return Splitter(vocab, count, sum, lambda i: 1)


def token_counts(docs: DataFrame, tokenizer_path: str, limit: int = 512, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Token count of every whole text, as the tokenizers library gives it for
    a byte-level BPE .json file without added begin or end tokens.

    One row per input row: ``doc_id, n_bytes, n_tokens, over_limit``. A null
    text counts as empty (0 bytes, 0 tokens); a null id stays null; repeated
    rows are counted each; other columns are ignored. No shuffle: each task
    reads its texts in Arrow batches and holds a bounded memo of pieces."""

    def counted(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        split = worker_held(("token_count", tokenizer_path), lambda: counter(tokenizer_path))
        for batch in batches:
            texts = batch.column("text").fill_null("")
            n = pa.array([split.of(t) for t in texts.to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pc.binary_length(texts).cast(pa.int64()), n, pc.greater(n, limit)],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(counted, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
