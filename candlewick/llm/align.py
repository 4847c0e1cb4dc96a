"""Alignment of the tokens of two tokenizers over the same bytes.

Both tokenizers cut a text (behind a space) into tokens with byte ends. An end
that both have splits the text into parts that align on their own, so groups
are found by divide and conquer: look for a common end near the middle of an
interval, by bisecting the other side's ends, and go on with both halves. An
interval without a common end inside is a leaf group. All open intervals of a
batch of texts take a step at a time, so a step is a few array operations.

A link is a pair of tokens with overlapping bytes. Between two neighbouring
ends of either side lies exactly one link, so a text has as many as it has
distinct ends. How often two ids are linked in the corpus needs all documents:
blocks of documents count their distinct id pairs, the counts are summed by
pair, and each block gets the sums of its own pairs back. A block keeps, by
pair, the documents and how many links they have, so no text is read twice."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.llm.blocks import payload_of, rows_of
from candlewick.llm.common import Scratch, tidy
from candlewick.llm.packing import Encoder
from candlewick.llm.pretoken import ByteBpe, worker_held

#: Probes around the middle of an interval before all its ends are looked up.
PROBES = 8
#: Texts aligned in one step, by bytes.
STEP_BYTES = 1 << 20
#: Documents of a block (their number takes 20 bits of a sort key).
BLOCK_DOCS = 1 << 20


class Sides:
    """Both vocabularies: ids, byte strings and byte lengths of tokens."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece

        self.a = Encoder(path_a)
        self.bytes_a = ByteBpe(path_a).token_bytes
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        size = self.b.get_piece_size()
        pieces = [self.b.id_to_piece(i) for i in range(size)]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.length_a, self.length_b = (np.array([len(t) for t in side], dtype=np.int64) for side in (self.bytes_a, self.bytes_b))
        self.bits_a, self.bits_b = (max(1, (len(side) - 1).bit_length()) for side in (self.bytes_a, self.bytes_b))
        # an id as it is written first in a group and behind another id, for either side
        self.written = [b"%s%d" % (sep, i) for sep, n in ((b";", len(self.bytes_a)), (b",", len(self.bytes_a)), (b"|", size), (b",", size)) for i in range(n)]

    def encode_a(self, text: str) -> np.ndarray:
        """Ids of ``text``; special strings in it are plain text."""
        try:
            return self.a.ids[self.a.lib.encode_to_numpy(text, allowed_special=set(), disallowed_special=())].astype(np.int64)
        except (KeyboardInterrupt, SystemExit, MemoryError):
            raise
        except BaseException:  # its pattern engine gives up on megabytes of white space
            from tokenizers import Tokenizer

            lib = Tokenizer.from_file(self.a.path)
            lib.encode_special_tokens = True
            return np.array(lib.encode(text, add_special_tokens=False).ids, dtype=np.int64)

    def encode(self, texts: list[str | None]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of either side; none where a side's tokens don't spell space+text."""
        none = np.empty(0, dtype=np.int64)
        all_b = self.b.encode([t or "" for t in texts], num_threads=1)
        out_a, out_b = [], []
        for text, b in zip(texts, all_b):
            a = none
            if text:
                raw = (" " + text).encode()
                if b"".join(map(self.bytes_b.__getitem__, b)) == raw:
                    a = self.encode_a(" " + text)
                    if b"".join(map(self.bytes_a.__getitem__, a.tolist())) != raw:
                        a = none
            out_a.append(a)
            out_b.append(np.array(b, dtype=np.int64) if len(a) else none)
        return out_a, out_b


def nearest_cut(ends_a: np.ndarray, ends_b: np.ndarray, a0: int, a1: int, b0: int, b1: int) -> int:
    """The token of A next to the middle of the interval whose end B has, too; -1: none."""
    ends, own = ends_a[a0 : a1 - 1], ends_b[b0 : b1 - 1]
    hits = np.flatnonzero(own[np.minimum(np.searchsorted(own, ends), len(own) - 1)] == ends)
    return a0 + int(hits[np.abs(2 * hits - (a1 - a0 - 2)).argmin()]) if len(hits) else -1


def leaf_groups(ends_a: np.ndarray, ends_b: np.ndarray, a0: np.ndarray, a1: np.ndarray, b0: np.ndarray, b1: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ends (in tokens of A and of B, ascending) of the groups of the intervals
    [a0, a1) x [b0, b1), whose last ends are common. ``ends`` ascend strictly."""
    done_a, done_b = [], []
    tries = np.zeros(len(a0), dtype=np.int64)
    while len(a0):
        leaf = (tries >= a1 - a0 - 1) | (b1 - b0 == 1)
        done_a.append(a1[leaf])
        done_b.append(b1[leaf])
        a0, a1, b0, b1, tries = (x[~leaf] for x in (a0, a1, b0, b1, tries))
        # from the middle outwards: 0, 1, -1, 2, -2, ...
        at = a0 + (a1 - a0 - 2) // 2 + np.where(tries & 1, (tries + 1) >> 1, -(tries >> 1))
        cutless = np.zeros(len(at), dtype=bool)
        for i in np.flatnonzero(tries >= PROBES):
            found = nearest_cut(ends_a, ends_b, int(a0[i]), int(a1[i]), int(b0[i]), int(b1[i]))
            cutless[i], at[i] = found < 0, max(found, a0[i])
        end = ends_a[at]
        to = np.searchsorted(ends_b, end)
        hit = (ends_b[to] == end) & ~cutless
        times = 1 + hit
        index = np.repeat(np.arange(len(at)), times)
        left = (np.cumsum(times) - times)[hit]
        a0, a1, b0, b1, tries = a0[index], a1[index], b0[index], b1[index], tries[index] + 1
        a1[left] = a0[left + 1] = at[hit] + 1
        b1[left] = b0[left + 1] = to[hit] + 1
        tries[left] = tries[left + 1] = 0
        tries[np.cumsum(times)[cutless] - 1] = 1 << 40  # a leaf in the next step
    none = np.empty(0, dtype=np.int64)
    return np.sort(np.concatenate([none, *done_a])), np.sort(np.concatenate([none, *done_b]))


def ends_of(parts: list[np.ndarray]) -> np.ndarray:
    return np.cumsum([len(p) for p in parts], dtype=np.int64)


class Aligned:
    """Groups and links of a few texts: per text ``n_a, n_b, n_groups,
    n_links`` and ``written`` (its groups as text); per link ``link_a,
    link_b`` (ids) in the order of the texts."""

    def __init__(self, sides: Sides, texts: list[str | None]):
        parts_a, parts_b = sides.encode(texts)
        a, b = np.concatenate(parts_a), np.concatenate(parts_b)
        stop_a, stop_b = ends_of(parts_a), ends_of(parts_b)
        self.n_a, self.n_b = np.diff(stop_a, prepend=0), np.diff(stop_b, prepend=0)
        ends_a, ends_b = np.cumsum(sides.length_a[a]), np.cumsum(sides.length_b[b])
        some = self.n_a > 0
        group_a, group_b = leaf_groups(ends_a, ends_b, (stop_a - self.n_a)[some], stop_a[some], (stop_b - self.n_b)[some], stop_b[some])
        self.n_groups = np.diff(np.searchsorted(group_a, stop_a, "right"), prepend=0)
        self.n_links = self.n_a + self.n_b - self.n_groups
        # one link between any two neighbouring ends
        marks = np.zeros(int(ends_a[-1]) + 1 if len(a) else 1, dtype=np.uint8)
        marks[ends_a] = 1
        marks[ends_b] += 2
        marks = marks[marks > 0]
        of_a, of_b = marks & 1, marks >> 1
        self.link_a = a[np.cumsum(of_a, dtype=np.int64) - of_a]
        self.link_b = b[np.cumsum(of_b, dtype=np.int64) - of_b]
        self.written = self._written(sides, a, b, group_a, group_b, stop_a + stop_b)

    @staticmethod
    def _written(sides: Sides, a, b, group_a, group_b, stops) -> list[bytes]:
        first_a, first_b = np.concatenate(([0], group_a[:-1])), np.concatenate(([0], group_b[:-1]))
        if not len(group_a):
            return [b""] * len(stops)
        codes = np.empty(len(a) + len(b), dtype=np.int64)
        code_a, code_b = a + len(sides.bytes_a), b + 2 * len(sides.bytes_a) + len(sides.bytes_b)
        code_a[first_a] -= len(sides.bytes_a)
        code_b[first_b] -= len(sides.bytes_b)
        codes[np.arange(len(a)) + np.repeat(first_b, group_a - first_a)] = code_a
        codes[np.arange(len(b)) + np.repeat(group_a, group_b - first_b)] = code_b
        say = sides.written.__getitem__
        return [b"".join(map(say, codes[i:j].tolist()))[1:] for i, j in zip([0, *stops[:-1].tolist()], stops.tolist())]


class Block:
    """What a block of documents keeps: a row per document and the sorted
    (pair, document) entries of its links."""

    def __init__(self, sides: Sides, keep_groups: bool):
        self.sides, self.keep_groups = sides, keep_groups
        self.docs = {c: [] for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "sha", "groups")}
        self.keys: list[np.ndarray] = []
        self.bytes = self.n = 0
        self.bits = (BLOCK_DOCS - 1).bit_length()
        if sides.bits_a + sides.bits_b + self.bits > 63:
            raise ValueError("the vocabularies are too large for a 63-bit pair key")

    def add(self, ids: list, texts: list, size: int) -> None:
        got = Aligned(self.sides, texts)
        doc = np.repeat(np.arange(self.n, self.n + len(ids)), got.n_links)
        # a sort key: pair, then document
        self.keys.append(((got.link_a << self.sides.bits_b | got.link_b) << self.bits) | doc)
        self.docs["doc_id"] += ids
        for c in ("n_a", "n_b", "n_groups", "n_links"):
            self.docs[c] += getattr(got, c).tolist()
        self.docs["sha"] += [hashlib.sha256(w).hexdigest() if w else "" for w in got.written]
        if self.keep_groups:
            self.docs["groups"] += [w.decode() for w in got.written]
        self.bytes, self.n = self.bytes + size, self.n + len(ids)

    def row(self, number: int) -> pa.RecordBatch:
        keys = np.concatenate(self.keys)
        self.keys = []
        keys.sort()
        start = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.empty(0, dtype=np.int64)
        entry, times = keys[start], np.diff(start, append=len(keys))
        pair, doc = entry >> self.bits, entry & (BLOCK_DOCS - 1)
        at = np.flatnonzero(np.concatenate(([True], pair[1:] != pair[:-1]))) if len(pair) else start
        counts = np.add.reduceat(times, at) if len(at) else times
        pair = pair[at]
        pair = (pair >> self.sides.bits_b) << 32 | pair & ((1 << self.sides.bits_b) - 1)
        # ascending documents of a pair as steps, in the narrowest type
        narrow = np.uint16 if self.n <= 1 << 16 else np.uint32
        lists = {c: pa.array([v]) for c, v in self.docs.items() if v}
        lists |= {
            "doc_id": pa.array([self.docs["doc_id"]], pa.list_(pa.int64())),
            "per_pair": pa.array([np.diff(at, append=len(entry)).astype(np.uint32)]),
            "step": pa.array([np.diff(doc.astype(narrow), prepend=narrow(0))]),
            "times": pa.array([times.astype(np.uint32 if (times >> 16).any() else np.uint16)]),
        }
        payload = payload_of(pa.RecordBatch.from_pydict(lists))
        return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([pair], pa.list_(pa.int64())), pa.array([counts], pa.list_(pa.int64())), pa.array([payload], pa.binary())], ["block", "pairs", "counts", "payload"])


def scored(payload: bytes, sums: np.ndarray, keep_groups: bool) -> pa.RecordBatch:
    """Rows of a block's documents; ``sums``: the corpus-wide count of each of
    its pairs, negative where it is the highest of its B id."""
    row = rows_of(payload)
    value = lambda c: row.column(c)[0].values
    per_pair, step, times = (value(c).to_numpy() for c in ("per_pair", "step", "times"))
    n = len(value("doc_id"))
    doc = np.cumsum(step, dtype=step.dtype)
    count = np.repeat(sums, per_pair)
    times = times.astype(np.int64)
    count_sum, n_best = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
    np.add.at(count_sum, doc, times * np.abs(count))
    np.add.at(n_best, doc[count < 0], times[count < 0])
    columns = [value("doc_id"), *(value(c) for c in ("n_a", "n_b", "n_groups", "n_links")), pa.array(n_best), pa.array(count_sum), value("sha")]
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    if keep_groups:
        columns, names = [*columns, value("groups")], [*names, "groups"]
    return pa.RecordBatch.from_arrays(columns, names)


def align_tokens(docs: DataFrame, path_a: str, path_b: str, block_bytes: int = 16 << 20, id_col: str = "doc_id", text_col: str = "text", keep_groups: bool = False) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_a, n_b, n_groups, n_links,
    n_best, count_sum, groups_sha256`` and, with ``keep_groups``, ``groups``
    ("a1,a2|b1;a3|b2,b3": ids of A and of B, groups in order).

    A is a byte-level BPE .json (tokenizers), B a sentencepiece .model that
    adds a space; A reads the text behind a space. Special strings inside texts
    are plain text. Texts that are null or empty, and texts that either side
    doesn't spell byte for byte (such as those with the character that B has
    for a space), have no tokens: zeros and an empty digest. ``n_best`` counts
    links whose corpus-wide count is the highest of their B id, ties included;
    ``count_sum`` adds up the counts of a document's links.

    Repeated rows are rows of their own and count as often; null ids stay null;
    other columns are ignored; an empty table has no rows. Texts are read whole.
    A worker holds the tokens of about a megabyte of text (or of one longer
    text) and the links of a block, about ``block_bytes`` of text."""
    scratch = Scratch(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def aligned(batches):
        from pyspark import TaskContext

        sides = worker_held(("align", path_a, path_b), lambda: Sides(path_a, path_b))
        number = TaskContext.get().partitionId() << 32
        block = Block(sides, keep_groups)
        for batch in batches:
            sizes = np.asarray(pc.binary_length(batch.column("text")).fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64) + 16
            steps = np.flatnonzero(np.diff((np.cumsum(sizes) - sizes) // STEP_BYTES)) + 1
            for i, j in zip([0, *steps.tolist()], [*steps.tolist(), batch.num_rows]):
                some = batch.slice(i, j - i)
                if not some.num_rows:
                    continue
                block.add(some.column("doc_id").to_pylist(), some.column("text").to_pylist(), int(sizes[i:j].sum()))
                if block.bytes >= block_bytes or block.n >= BLOCK_DOCS // 2:
                    yield block.row(number)
                    number, block = number + 1, Block(sides, keep_groups)
        if block.n:
            yield block.row(number)

    blocks = scratch.table(rows.mapInArrow(tidy(aligned), "block long, pairs array<long>, counts array<long>, payload binary"))
    asked = blocks.select("block", F.posexplode(F.arrays_zip("pairs", "counts")).alias("i", "x")).select("block", "i", F.col("x.pairs").alias("pair"), F.col("x.counts").alias("n"))
    sums = scratch.table(asked.groupBy("pair").agg(F.sum("n").alias("n")).withColumn("b", F.col("pair").bitwiseAND(F.lit((1 << 32) - 1))))
    highest = sums.groupBy("b").agg(F.max("n").alias("most"))
    told = sums.join(highest, "b").select("pair", F.when(F.col("n") == F.col("most"), -F.col("n")).otherwise(F.col("n")).alias("told"))
    answers = asked.select("block", "i", "pair").join(told, "pair").groupBy("block").agg(F.array_sort(F.collect_list(F.struct("i", "told"))).alias("x"))
    answers = answers.select("block", F.col("x.told").alias("told"))

    def finished(batches):
        for batch in batches:
            for payload, told in zip(batch.column("payload"), batch.column("told")):
                sums = told.values.to_numpy() if told.is_valid else np.empty(0, dtype=np.int64)
                yield scored(payload.as_py(), sums, keep_groups)

    schema = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    both = blocks.select("block", "payload").join(answers, "block", "left").select("payload", "told")
    return both.mapInArrow(tidy(finished), schema + (", groups string" if keep_groups else ""))
