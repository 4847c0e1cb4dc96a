"""Packing by non-negative least squares.

Every document is cut into full windows and one tail. Shallow combinations of
tail lengths that fill a window exactly are enumerated, their repeat counts
are solved against the histogram of tail lengths by non-negative least
squares, rounded to what the histogram can serve, and the tails left over are
packed greedily one behind the other. Since a sequence whose length is a power
of two needs no padding, the last residual sequence is cut into such lengths.

Placing a tail needs its rank among the tails of its length. Each task counts
ranks inside its own partition; only (partition, length) counts are shuffled
to give partitions their offsets, so no task sees more than one partition or
one length's counts, and a length shared by a third of all documents is dealt
out like any other."""

from __future__ import annotations

import itertools
import zlib

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candlewick.llm.common import Scratch
from candlewick.llm.pretoken import SPLIT, ByteBpe, worker_held

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class Encoder:
    """Text -> uint32 ids, equal to the tokenizers library's for a byte-level
    BPE .json (special strings included): its merge list, by rank, runs in
    tiktoken, which is several times faster; ids are mapped back by table."""

    def __init__(self, path: str):
        import tiktoken

        vocab = ByteBpe(path)
        rank_of = {bytes([b]): b for b in range(256)}
        ids = [vocab.byte_ids[b] for b in range(256)]
        for new in vocab.new_ids:
            token = vocab.token_bytes[new]
            if token in rank_of:
                raise ValueError(f"{path}: two merges make one token")
            rank_of[token] = len(ids)
            ids.append(new)
        special = {}
        for text, i in vocab.special.items():
            special[text] = len(ids)
            ids.append(i)
        self.ids = np.array(ids, dtype=np.uint32)
        self.path = path
        self.lib = tiktoken.Encoding(path, pat_str=SPLIT, mergeable_ranks=rank_of, special_tokens=special)

    def __call__(self, text: str) -> np.ndarray:
        try:
            return self.ids[self.lib.encode_to_numpy(text, allowed_special="all")]
        except (KeyboardInterrupt, SystemExit, MemoryError):
            raise
        except BaseException:  # its pattern engine gives up on megabytes of white space
            from tokenizers import Tokenizer

            return np.array(Tokenizer.from_file(self.path).encode(text, add_special_tokens=False).ids, dtype=np.uint32)


# ---------------------------------------------------------------- repeat counts


def nnls(places: np.ndarray, target: np.ndarray, rounds: int = 300) -> np.ndarray:
    """min ||A x - target||, x >= 0, by accelerated projected gradient.
    Row k of ``places`` lists the lengths column k uses (0: none)."""
    m, size = len(places), len(target)
    flat, used = places.ravel(), (places > 0).astype(float)

    def times(x):
        return np.bincount(flat, (used * x[:, None]).ravel(), size)

    def back(r):
        return (r[places] * used).sum(axis=1)

    v = np.ones(m)
    for _ in range(20):
        v = back(times(v))
        top = np.linalg.norm(v)
        v /= top
    x = y = np.zeros(m)
    t = 1.0
    for _ in range(rounds):
        new = np.maximum(0, y - back(times(y) - target) / (1.05 * top))
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y, x, t = new + (t - 1) / t_new * (new - x), new, t_new
    return x


def plan(histogram: np.ndarray, window: int, depth: int = 3, columns: int = 4096) -> list[tuple[int, int, int, int, int]]:
    """Rows (length, from rank, to rank, sequence, offset): the tails of that
    length and rank go to consecutive sequences from ``sequence`` on, at
    ``offset``. Starts from all pairs that fill the window and adds the deeper
    combinations that the remaining residual asks for most, at most
    ``columns`` in all; ranks not covered are left over."""
    size = window
    target = histogram[:size].astype(float)
    target[0] = 0
    pairs = [(a, window - a) for a in range(1, window // 2 + 1)]
    places = np.array([(a, b) + (0,) * (depth - 2) for a, b in pairs], dtype=np.int64).reshape(-1, max(depth, 2))
    deeper = []
    for d in range(3, depth + 1):
        for head in itertools.combinations_with_replacement(range(1, window), d - 2):
            rest = window - sum(head)
            a = np.arange(head[-1], rest // 2 + 1)
            if len(a):
                deeper.append(np.column_stack([np.tile(head, (len(a), 1)), a, rest - a, np.zeros((len(a), depth - d), dtype=np.int64)]))
    deeper = np.concatenate(deeper) if deeper else np.empty((0, places.shape[1]), dtype=np.int64)
    x = nnls(places, target)
    for _ in range(3):
        if len(places) >= columns or not len(deeper):
            break
        left = target - np.bincount(places.ravel(), np.repeat(x, places.shape[1]), size)
        left[0] = 0
        gain = left[deeper].sum(axis=1)
        best = np.argsort(-gain, kind="stable")[: min(1200, columns - len(places))]
        best = best[gain[best] > 0.5]
        if not len(best):
            break
        places = np.concatenate([places, deeper[best]])
        deeper = np.delete(deeper, best, axis=0)
        x = nnls(places, target)
    free, rows, sequence = histogram.astype(np.int64).copy(), [], 0
    taken = np.zeros(size, dtype=np.int64)
    for k in np.argsort(-x, kind="stable"):
        lengths = [int(v) for v in places[k] if v]
        need = {v: lengths.count(v) for v in lengths}
        times = min(int(np.rint(x[k])), *(int(free[v]) // c for v, c in need.items()))
        if times <= 0:
            continue
        at = 0
        for v in lengths:
            rows.append((v, int(taken[v]), int(taken[v]) + times, sequence, at))
            taken[v] += times
            free[v] -= times
            at += v
        sequence += times
    return rows


# ---------------------------------------------------------------- the operator


def pack(docs: DataFrame, tokenizer_path: str, window: int = 1024, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """Pieces of all documents, packed into sequences of at most ``window``
    tokens; ``sequence_id`` counts from 0 without gaps.

    One row per piece (see PIECES; with ``keep_ids`` also ``ids``). A document
    is its ids and then ``end_id``, so a null or empty text is one piece of one
    token. Repeated rows and repeated or null ids are packed row by row; other
    columns are ignored; an empty table gives no pieces. The driver receives
    at most ``window`` histogram counts. Writes one table (lengths, checksums
    and tail ids) to the scratch folder."""

    def cut(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        encode = worker_held(("encoder", tokenizer_path), lambda: Encoder(tokenizer_path))
        pid = TaskContext.get().partitionId()
        seq = full_before = 0
        ranks = [0] * window
        end = np.array([end_id], dtype="<u4")
        for batch in batches:
            rows = []
            for text in batch.column("text").fill_null("").to_pylist():
                ids = np.concatenate([encode(text), end]).astype("<u4")
                raw, n = ids.tobytes(), len(ids)
                full, tail = divmod(n, window)
                cut_at = 4 * window * full
                crcs = [zlib.crc32(raw[4 * window * b : 4 * window * (b + 1)]) for b in range(full)]
                rows.append((n, full_before, crcs, tail, ranks[tail], zlib.crc32(raw[cut_at:]), raw if keep_ids else raw[cut_at:]))
                ranks[tail] += 1
                full_before += full
            n, before, crcs, tail, rank, crc, ids = zip(*rows) if rows else [[]] * 7
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([pid] * len(rows), pa.int64()), pa.array(range(seq, seq + len(rows)), pa.int64()), batch.column("doc_id"),
                    pa.array(n, pa.int64()), pa.array(before, pa.int64()), pa.array(crcs, pa.list_(pa.int64())), pa.array(tail, pa.int32()),
                    pa.array(rank, pa.int64()), pa.array(crc, pa.int64()), pa.array(ids, pa.binary()),
                ],
                ["pid", "seq", "doc_id", "doc_tokens", "full_before", "crcs", "tail", "rank", "tail_crc", "ids"],
            )
            seq += len(rows)

    scratch = Scratch(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    cut_schema = "pid long, seq long, doc_id long, doc_tokens long, full_before long, crcs array<long>, tail int, rank long, tail_crc long, ids binary"
    cut_rows = scratch.table(rows.mapInArrow(cut, cut_schema))

    # (partition, tail length) counts: at most `window` rows per partition
    counts = scratch.table(cut_rows.groupBy("pid", "tail").agg(F.count("*").alias("n"), F.sum(F.size("crcs")).alias("full")))
    totals = counts.groupBy("tail").agg(F.sum("n").alias("n"), F.sum("full").alias("full")).collect()  # <= window rows
    histogram = np.zeros(window, dtype=np.int64)
    for r in totals:
        histogram[r["tail"]] = r["n"]
    n_full = sum(r["full"] for r in totals)
    histogram[0] = 0
    places = plan(histogram, window)
    quota = [0] * window
    for length, _, to, _, _ in places:
        quota[length] = max(quota[length], to)
    planned = max([to - since + first for _, since, to, first, _ in places], default=0)
    left_total = int(sum((int(histogram[v]) - quota[v]) * v for v in range(window)))

    by_length = Window.partitionBy("tail").orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    by_pid = Window.orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    quotas = F.array(*[F.lit(q).cast("long") for q in quota])
    based = counts.withColumn("base", F.coalesce(F.sum("n").over(by_length), F.lit(0)))
    served = F.greatest(F.lit(0), F.least(F.col("n"), F.get(quotas, F.col("tail")) - F.col("base")))
    offsets = (
        based.withColumn("left", (F.col("n") - served) * F.col("tail"))
        .groupBy("pid")
        .agg(F.map_from_entries(F.collect_list(F.struct("tail", "base"))).alias("bases"), F.sum("left").alias("left"), F.sum("full").alias("full"))
        .select(
            "pid", "bases",
            F.coalesce(F.sum("full").over(by_pid), F.lit(0)).alias("full_base"),
            F.coalesce(F.sum("left").over(by_pid), F.lit(0)).alias("left_base"),
        )
    )
    in_order = Window.partitionBy("pid").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    placed = (
        cut_rows.join(offsets, "pid")
        .withColumn("rank", F.col("rank") + F.col("bases")[F.col("tail")])
        .withColumn("left", F.when(F.col("rank") >= F.get(quotas, F.col("tail")), F.col("tail")).otherwise(0))
        .withColumn("left_at", F.col("left_base") + F.coalesce(F.sum("left").over(in_order), F.lit(0)))
        .select("doc_id", "doc_tokens", (F.col("full_base") + F.col("full_before")).alias("full_at"), "crcs", "tail", "rank", "tail_crc", "left", "left_at", "ids")
    )

    places.sort()
    keys = np.array([[length, since] for length, since, *_ in places], dtype=np.int64).reshape(-1, 2)
    goes = np.array([[first, at] for *_, first, at in places], dtype=np.int64).reshape(-1, 2)
    whole = left_total // window * window
    ends, at = [], whole  # ends of the last, partial residual sequences: powers of two
    for bit in reversed(range(window.bit_length())):
        if left_total - whole >> bit & 1:
            at += 1 << bit
            ends.append(at)

    def emit(batches):
        import bisect

        import pyarrow as pa

        order = [tuple(k) for k in keys.tolist()]
        for batch in batches:
            out, ids_out = [], []
            for r in batch.to_pylist():
                raw, n, tail, doc = r["ids"], r["doc_tokens"], r["tail"], r["doc_id"]
                start = n - tail
                shift = 0 if keep_ids else start

                def piece(start, length, crc, sequence, offset):
                    out.append((doc, start, length, crc, n, sequence, offset))
                    if keep_ids:
                        ids_out.append(np.frombuffer(raw[4 * start : 4 * (start + length)], "<u4").astype("i4"))

                for b, crc in enumerate(r["crcs"]):
                    piece(b * window, window, crc, r["full_at"] + b, 0)
                if tail and not r["left"]:
                    k = bisect.bisect_right(order, (tail, r["rank"])) - 1
                    first, offset = goes[k].tolist()
                    piece(start, tail, r["tail_crc"], n_full + first + r["rank"] - order[k][1], offset)
                at, stop = r["left_at"], r["left_at"] + r["left"]
                while at < stop:
                    if at < whole:
                        number, begins, to = at // window, at // window * window, (at // window + 1) * window
                    else:
                        k = bisect.bisect_right(ends, at)
                        number, begins, to = whole // window + k, ([whole] + ends)[k], ends[k]
                    length = min(stop, to) - at
                    crc = zlib.crc32(raw[4 * (start - shift) : 4 * (start - shift + length)])
                    piece(start, length, crc, n_full + planned + number, at - begins)
                    start, at = start + length, at + length
            cols = list(zip(*out)) if out else [[]] * 7
            arrays = [pa.array(c, pa.int64()) for c in cols]
            if keep_ids:
                arrays.append(pa.array(ids_out, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(arrays, names)

    names = [c.split()[0] for c in PIECES.split(", ")] + ["ids"] * keep_ids
    return placed.mapInArrow(emit, PIECES + ", ids array<int>" * keep_ids)


def sequences(pieces: DataFrame, window: int = 1024, pad_id: int = 0) -> DataFrame:
    """The packed sequences themselves, from pieces with ``ids``: one row per
    sequence, padded to ``window`` unless its length is a power of two."""
    joined = pieces.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    ids = F.flatten(F.col("parts.ids"))
    n = F.size("ids")
    padded = F.when(F.bit_count(n) == 1, F.col("ids")).otherwise(F.concat("ids", F.array_repeat(F.lit(pad_id), F.lit(window) - n)))
    return joined.select("sequence_id", ids.alias("ids")).select("sequence_id", n.alias("n_tokens"), padded.alias("ids"))
