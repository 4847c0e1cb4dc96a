"""Substring dedup with repeated-phrase automata.

1. Recurring passages are found by hash. Every ``window`` consecutive words
   contain a content-chosen anchor (the phrase of ``anchor`` words with the
   least hash); equal windows have equal anchors, so only windows whose anchor
   occurs in several blocks can recur between blocks. Their 96-bit hashes are
   sorted by (document id, start) across the corpus, which confirms what
   recurs and says, per block, which windows start earlier elsewhere.
2. Each block of documents compiles the confirmed passages it holds into
   Aho-Corasick automata, in shards of bounded size, and streams its texts
   through them to locate every occurrence; covered words are removed.

Exact copies of a text with a smaller id are recognised by digest first, so a
group of copies of any size costs one text's windows. All messages are keyed
by block: at most one row per block and distinct window crosses the network,
however often a passage occurs."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.llm.blocks import NO_ID, rows_of, texts_of, to_blocks
from candlewick.llm.common import Scratch, Words, mix, tidy

#: Characters of patterns per automaton (about 40 bytes of memory each).
SHARD_CHARS = 1 << 21
_TURN = np.uint64(0xD6E8FEB86659FD93)


def chained(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of ``n`` consecutive values, by doubling."""

    def joined(left, right):  # hash of a run from those of its two parts
        size = min(len(left), len(right))
        return mix(left[:size] * _TURN, right[:size])

    out, have, power, width = None, 0, h, 1
    while True:
        if n & width:
            out = power if out is None else joined(out, power[have:])
            have += width
        if have == n:
            return out
        power = joined(power, power[width:])
        width *= 2


def least(values: np.ndarray, n: int) -> np.ndarray:
    """Minimum of each run of ``n`` consecutive values."""
    out, width = values, 1
    while width < n:
        step = min(width, n - width)
        out = np.minimum(out[: len(out) - step], out[step:])
        width += step
    return out


class Windows:
    """Of a block's texts: words, and per valid window its first word (``at``),
    document, start, anchor hash and 96-bit hash (``w``, ``w2``)."""

    def __init__(self, texts: list[bytes], window: int, anchor: int):
        self.words = words = Words(texts, lower=False)
        h, n = words.hashes, len(words.start)
        self.doc_of = np.repeat(np.arange(len(texts)), np.diff(words.first))
        last = max(0, n - window + 1)
        ok = self.doc_of[:last] == self.doc_of[n - last :]
        self.at = np.flatnonzero(ok)
        self.doc = self.doc_of[self.at]
        self.start = self.at - words.first[self.doc]
        if last:
            self.anchor = least(chained(h, anchor), window - anchor + 1)[self.at]
            self.w = chained(h, window)[self.at]
            self.w2 = (chained(h * _TURN, window)[self.at] >> np.uint64(33)).astype(np.int32)
        else:
            self.anchor = self.w = np.empty(0, np.uint64)
            self.w2 = np.empty(0, np.int32)


def occurrences(text: bytes, patterns: list[bytes]):
    """(pattern number, end offset) of every occurrence of every pattern in
    ``text``, from automata of at most SHARD_CHARS characters each."""
    import ahocorasick

    text = text.decode("latin-1")
    at = 0
    while at < len(patterns):
        automaton, size = ahocorasick.Automaton(), 0
        while at < len(patterns) and (not size or size + len(patterns[at]) <= SHARD_CHARS):
            automaton.add_word(patterns[at].decode("latin-1"), at)
            size += len(patterns[at])
            at += 1
        automaton.make_automaton()
        for end, number in automaton.iter(text):
            yield number, end + 1


def removed_words(texts: list[bytes], ids: np.ndarray, copies: np.ndarray, flagged: np.ndarray, window: int, anchor: int):
    """Boolean per word of the block: does it go? ``flagged``: first words of
    windows (the first of their kind in the block) that start earlier in
    another block; ``copies``: texts that are copies of one with a smaller id."""
    wins = Windows(texts, window, anchor)
    words = wins.words
    gone = np.zeros(len(words.start), dtype=bool)
    counts = np.diff(words.first)
    whole = copies & (counts >= window)
    gone[np.repeat(whole, counts)] = True
    live = ~copies[wins.doc]
    at, doc, start, w = wins.at[live], wins.doc[live], wins.start[live], wins.w[live]
    if not len(at):
        return words, gone
    order = np.lexsort((start, ids[doc], w))
    first = np.concatenate(([True], w[order][1:] != w[order][:-1]))
    sizes = np.diff(np.append(np.flatnonzero(first), len(order)))
    heads = order[first]  # the first of each kind
    early = np.isin(at[heads], flagged)
    # windows that occur once here: runs of those that start earlier elsewhere
    # make one passage; windows that occur repeatedly are patterns themselves
    once = np.sort(at[heads[early & (sizes == 1)]])
    cut = np.flatnonzero((np.diff(once) != 1) | (wins.doc_of[once[1:]] != wins.doc_of[once[:-1]])) + 1 if len(once) else np.empty(0, int)
    runs = [(r[0], r[-1] + window) for r in np.split(once, cut) if len(r)]
    repeated = np.flatnonzero(sizes > 1)
    if not runs and not len(repeated):
        return words, gone
    plain = [texts_bytes(words, i) for i in range(len(texts))]
    joined = b"".join(plain)
    # offset of each word in `joined`: every text is " w1 w2 ... wn "
    length = words.end - words.start
    where = np.cumsum(length + 1) - length + np.repeat(np.cumsum(counts > 0) - 1, counts)
    patterns: dict[bytes, tuple[int, bool, tuple]] = {}

    def pattern(a, b):
        return joined[where[a] - 1 : where[b - 1] + length[b - 1] + 1]

    for a, b in runs:
        patterns.setdefault(pattern(a, b), (b - a, True, ()))
    for k in repeated.tolist():
        a = int(at[heads[k]])
        patterns[pattern(a, a + window)] = (window, bool(early[k]), (int(ids[doc[heads[k]]]), int(start[heads[k]])))
    facts = list(patterns.values())
    ends = where + length
    cover = np.zeros(len(gone) + 1, dtype=np.int64)
    hits = [(n, e) for n, e in occurrences(joined, list(patterns))]
    if hits:
        number, end = np.array(hits, dtype=np.int64).T
        last = np.searchsorted(ends, end - 1)
        many = np.array([f[0] for f in facts])[number]
        begin = last - many + 1
        who = wins.doc_of[begin]
        always = np.array([f[1] for f in facts])[number]
        head_id = np.array([f[2][0] if f[2] else 0 for f in facts])[number]
        head_at = np.array([f[2][1] if f[2] else 0 for f in facts])[number]
        begins = begin - words.first[who]
        later = (ids[who] > head_id) | ((ids[who] == head_id) & (begins > head_at))
        take = (always | later) & ~copies[who]
        np.add.at(cover, begin[take], 1)
        np.add.at(cover, last[take] + 1, -1)
    gone |= np.cumsum(cover)[:-1] > 0
    return words, gone


def texts_bytes(words: Words, i: int) -> bytes:
    """Text ``i`` as ' w1 w2 ... wn ' (nothing for a text without words)."""
    a, b = words.first[i], words.first[i + 1]
    raw = words.raw[words.start[a] : words.end[b - 1]].tobytes() if b > a else b""
    return b" " + b" ".join(raw.split()) + b" " if b > a else b""


def dedup_substrings(docs: DataFrame, window: int = 20, anchor: int = 5, block_bytes: int = 4 << 20, id_col: str = "doc_id", text_col: str = "text", keep_rows: bool = False) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_words, n_removed, kept_sha256``, or with
    ``keep_rows`` the row itself with the removed words cut out of its text
    (texts that lose nothing stay as they are, others are their kept words
    joined by one space).

    A word goes if a window over it equals one that starts earlier: in a
    document of smaller id, or earlier under the same id. Null ids sort last
    and share one place; rows that repeat id and text are one document and
    lose the same words; null and empty texts have no words; other columns are
    ignored; an empty table gives no rows."""
    scratch = Scratch(docs.sparkSession)
    blocks = to_blocks(docs, scratch, id_col, text_col, block_bytes, keep_rows)
    order_id = F.coalesce(F.col("key.doc_id"), F.lit(NO_ID))

    keyed = blocks.select("block", F.posexplode("keys").alias("place", "key")).select("block", "place", order_id.alias("id"), F.col("key.digest").alias("digest"))
    firsts = keyed.groupBy("digest").agg(F.min("id").alias("first"))
    copies = keyed.join(firsts, "digest").where("id > first").groupBy("block").agg(F.collect_list("place").alias("copies"))
    copies = scratch.table(copies)

    def anchored(batches):
        for batch in batches:
            for block, payload in zip(batch.column("block").to_pylist(), batch.column("payload")):
                found = np.unique(Windows(texts_of(rows_of(payload.as_py())), window, anchor).anchor)
                yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(np.full(len(found), block))], ["anchor", "block"])

    def sorted_groups(batches, key: list[str], closed):
        """Feeds ``closed`` with rows of whole groups of equal ``key``."""
        held = None
        for batch in batches:
            rows = [batch.column(c).to_numpy() for c in batch.schema.names]
            if held is not None:
                rows = [np.concatenate(x) for x in zip(held, rows)]
            if not len(rows[0]):
                continue
            same = np.ones(len(rows[0]), dtype=bool)
            for k in range(len(key)):
                same &= rows[k] == rows[k][-1]
            last = len(same) if not same.any() else int(np.flatnonzero(~same)[-1]) + 1 if (~same).any() else 0
            held = [x[last:] for x in rows]
            if last:
                yield closed([x[:last] for x in rows])
        if held is not None and len(held[0]):
            yield closed(held)

    def shared(batches):
        """Anchors that several blocks hold, once per block."""

        def closed(rows):
            value, block = rows
            starts = np.concatenate(([0], np.flatnonzero(value[1:] != value[:-1]) + 1))
            sizes = np.diff(np.append(starts, len(value)))
            keep = np.repeat(sizes > 1, sizes)
            return pa.RecordBatch.from_arrays([pa.array(block[keep]), pa.array(value[keep])], ["block", "anchor"])

        return sorted_groups(batches, ["anchor"], closed)

    asked = blocks.select("block", "payload").mapInArrow(tidy(anchored), "anchor long, block long")
    recurring = asked.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(shared, "block long, anchor long")
    del asked
    recurring = scratch.table(recurring.groupBy("block").agg(F.collect_list("anchor").alias("anchors")))

    def nominated(batches):
        for batch in batches:
            for block, payload, anchors, place in zip(batch.column("block").to_pylist(), batch.column("payload"), batch.column("anchors"), batch.column("copies").to_pylist()):
                rows = rows_of(payload.as_py())
                wins = Windows(texts_of(rows), window, anchor)
                ids = ids_of(rows)
                copy = copies_of(len(ids), place)
                known = np.array(anchors.values.to_numpy() if anchors.is_valid else [], dtype=np.int64).view(np.uint64)
                take = np.flatnonzero(np.isin(wins.anchor, known) & ~copy[wins.doc])
                by = take[np.lexsort((wins.start[take], ids[wins.doc[take]], wins.w[take]))]
                w = wins.w[by]
                by = by[np.concatenate(([True], w[1:] != w[:-1]))] if len(by) else by
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(wins.w[by].view(np.int64)), pa.array(wins.w2[by]), pa.array(ids[wins.doc[by]]), pa.array(wins.start[by].astype(np.int32)),
                        pa.array(np.full(len(by), block)), pa.array(wins.at[by].astype(np.int32)),
                    ],
                    ["w", "w2", "id", "start", "block", "at"],
                )

    def later(batches):
        """Windows (by block and first word) that start earlier elsewhere."""

        def closed(rows):
            w, w2, doc, start, block, at = rows
            starts = np.concatenate(([0], np.flatnonzero((w[1:] != w[:-1]) | (w2[1:] != w2[:-1])) + 1))
            sizes = np.diff(np.append(starts, len(w)))
            keep = (doc != np.repeat(doc[starts], sizes)) | (start != np.repeat(start[starts], sizes))
            return pa.RecordBatch.from_arrays([pa.array(block[keep]), pa.array(at[keep])], ["block", "at"])

        return sorted_groups(batches, ["w", "w2"], closed)

    asked = blocks.select("block", "payload").join(recurring, "block", "left").join(copies, "block", "left")
    asked = asked.select("block", "payload", "anchors", "copies").mapInArrow(tidy(nominated), "w long, w2 int, id long, start int, block long, at int")
    flagged = asked.repartition("w", "w2").sortWithinPartitions("w", "w2", "id", "start").mapInArrow(later, "block long, at int")
    del asked
    flagged = scratch.table(flagged.groupBy("block").agg(F.collect_list("at").alias("flagged")))
    scratch.drop(recurring)
    del recurring
    scratch.release()

    width = len(docs.columns)
    text_at = docs.columns.index(text_col)

    def located(batches):
        for batch in batches:
            for payload, at, place in zip(batch.column("payload"), batch.column("flagged"), batch.column("copies").to_pylist()):
                rows = rows_of(payload.as_py())
                texts = texts_of(rows)
                marks = np.array(at.values.to_numpy() if at.is_valid else [], dtype=np.int64)
                words, gone = removed_words(texts, ids_of(rows), copies_of(len(texts), place), marks, window, anchor)
                n = np.diff(words.first)
                lost = np.diff(np.concatenate(([0], np.cumsum(gone)))[words.first])
                kept = []
                for i, text in enumerate(texts):
                    pieces = text.split() if n[i] else []
                    if lost[i]:
                        stay = ~gone[words.first[i] : words.first[i + 1]]
                        pieces = [p for p, s in zip(pieces, stay.tolist()) if s]
                    kept.append(b" ".join(pieces))
                if keep_rows:
                    original = rows.column("_text").to_pylist()
                    new = [original[i] if not lost[i] else kept[i].decode() for i in range(len(kept))]
                    cols = [pa.array(new, pa.string()) if i == text_at else rows.column(f"c{i}") for i in range(width)]
                    yield pa.RecordBatch.from_arrays(cols, [f"c{i}" for i in range(width)])
                else:
                    digests = [hashlib.sha256(k).hexdigest() for k in kept]
                    yield pa.RecordBatch.from_arrays([rows.column("_id"), pa.array(n.astype(np.int64)), pa.array(lost.astype(np.int64)), pa.array(digests, pa.string())], ["doc_id", "n_words", "n_removed", "kept_sha256"])

    joined = blocks.select("block", "payload").join(flagged, "block", "left").join(copies, "block", "left").select("payload", "flagged", "copies")
    if not keep_rows:
        return joined.mapInArrow(tidy(located), "doc_id long, n_words long, n_removed long, kept_sha256 string")
    schema = ", ".join(f"c{i} {f.dataType.simpleString()}" if i != text_at else f"c{i} string" for i, f in enumerate(docs.schema))
    return joined.mapInArrow(tidy(located), schema).toDF(*docs.columns)


def ids_of(rows: pa.RecordBatch) -> np.ndarray:
    return rows.column("_id").fill_null(NO_ID).to_numpy()


def copies_of(n: int, places) -> np.ndarray:
    out = np.zeros(n, dtype=bool)
    out[places or []] = True
    return out
