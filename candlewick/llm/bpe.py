"""BPE encoding and decoding with a contiguous rank array.

A short word is held as part boundaries with the rank of each adjacent pair;
the minimum is found by scanning, its boundary is deleted and the two
neighbouring ranks are refreshed. Long words, where scanning would be
quadratic, go to the heap form of the same merge order."""

from __future__ import annotations

import hashlib
import sys
from array import array

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.llm.pretoken import ID_BITS, ByteBpe, Splitter, heap_merge, worker_held

#: Words of more bytes use the heap.
SHORT = 96
NO_RANK = 1 << 30


def merge_short(parts: list[int], ranks: dict[int, int], new_ids: list[int]) -> list[int]:
    """Ids of one short word; ``parts`` holds the ids of its bytes."""
    get = ranks.get
    near = [get(a << ID_BITS | b, NO_RANK) for a, b in zip(parts, parts[1:])]
    while near:
        best = min(near)
        if best == NO_RANK:
            break
        i = near.index(best)
        parts[i] = new = new_ids[best]
        del parts[i + 1], near[i]
        if i < len(near):
            near[i] = get(new << ID_BITS | parts[i + 1], NO_RANK)
        if i:
            near[i - 1] = get(parts[i - 1] << ID_BITS | new, NO_RANK)
    return parts


class Codec:
    """encode(text) -> little-endian uint32 ids as bytes; decode(ids) -> text."""

    def __init__(self, tokenizer_path: str):
        vocab = ByteBpe(tokenizer_path)
        byte_id, ranks, new_ids = vocab.byte_ids.__getitem__, vocab.ranks, vocab.new_ids
        self.token_bytes = vocab.token_bytes

        def ids(piece: bytes) -> bytes:
            parts = list(map(byte_id, piece))
            if len(parts) <= SHORT:
                parts = merge_short(parts, ranks, new_ids)
            else:
                heap_merge(parts, ranks, new_ids)
                parts = [p for p in parts if p >= 0]
            return packed(parts)

        self.encode = Splitter(vocab, ids, b"".join, lambda i: packed([i])).of

    def decode(self, ids) -> str:
        return b"".join(map(self.token_bytes.__getitem__, ids)).decode("utf-8", "replace")


def packed(ids: list[int]) -> bytes:
    out = array("I", ids)
    if sys.byteorder == "big":
        out.byteswap()
    return out.tobytes()


def bpe_round_trip(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """Encode every whole text and decode the ids again.

    One row per input row: ``doc_id, n_tokens, ids_sha256, decoded_sha256``
    and, with ``keep_ids``, ``ids`` (array of int) and ``decoded`` (string).
    Null text counts as empty; null ids stay null; repeated rows give a row
    each; other columns are ignored. No shuffle; memory per task is one Arrow
    batch and two bounded memos."""

    def coded(batches):
        import numpy as np
        import pyarrow as pa

        codec = worker_held(("bpe", tokenizer_path), lambda: Codec(tokenizer_path))
        sha = hashlib.sha256
        for batch in batches:
            n, enc, dec, ids_out, texts_out = [], [], [], [], []
            for text in batch.column("text").fill_null("").to_pylist():
                ids = codec.encode(text)
                numbers = np.frombuffer(ids, "<u4")
                back = codec.decode(numbers.tolist())
                n.append(len(numbers))
                enc.append(sha(ids).hexdigest())
                dec.append(sha(back.encode()).hexdigest())
                if keep_ids:
                    ids_out.append(numbers.astype("i4"))
                    texts_out.append(back)
            cols = [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(enc, pa.string()), pa.array(dec, pa.string())]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if keep_ids:
                cols += [pa.array(ids_out, pa.list_(pa.int32())), pa.array(texts_out, pa.string())]
                names += ["ids", "decoded"]
            yield pa.RecordBatch.from_arrays(cols, names)

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(coded, schema + (", ids array<int>, decoded string" if keep_ids else ""))
