"""Language-model scores with a weighted backoff automaton.

States are the n-gram contexts seen in training, arcs the seen n-grams with
their smoothed log-probability, and every state has a failure arc to its
suffix. With Dirichlet smoothing, p(w|h) = (c(hw) + k p(w|h')) / (c(h) + k),
the weight of a failure arc is log k / (c(h) + k); the root is the add-one
unigram model, which keeps mass for unknown words. A text is read once from
left to right, carrying the state: at each token the automaton takes the arc
of the state it is in, or fails to shorter ones, adding their weights, until
one has an arc. Many texts are read side by side, a token of each at a time.

The model never sits in one place. Each block of documents counts its own
n-grams and sends them, sorted by hash, to the shards of the hash range; a
shard sums what all blocks sent and answers each with totals in the order of
its question. So a block gets the part of the automaton its own documents can
walk through, never more than its own size."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.llm.blocks import rows_of, texts_of, to_blocks
from candlewick.llm.common import Scratch, Words, crc_mod_of, mix, shards_for, tidy

#: N-grams that a shard sums at once, about (with their sort 100 MB).
SHARD_GRAMS = 2 << 20
#: Smoothing of orders 2 and 3, chosen on a second split of the training rows (README).
STRENGTHS = (8192.0, 4.0)
START, END = np.uint64(0x5354415254), np.uint64(0x454E44)


def token_grams(texts: list[bytes], order: int):
    """Token hashes of all texts (words, then one end each), the token range of
    each text and, per order k, the hash of the k-gram that ends at each token
    (0 where the text has too few tokens before it; the start counts as one)."""
    words = Words(texts, lower=True)
    n = len(texts)
    counts = np.diff(words.first) + 1
    first = np.concatenate(([0], np.cumsum(counts)))
    tokens = np.full(first[-1], END, dtype=np.uint64)
    is_word = np.ones(first[-1], dtype=bool)
    is_word[first[1:] - 1] = False
    tokens[is_word] = words.hashes
    place = np.arange(first[-1]) - np.repeat(first[:-1], counts)  # within its text
    grams = [tokens]
    for k in range(2, order + 1):
        before = np.empty_like(tokens)
        before[1:] = grams[-1][:-1]
        if n:
            before[first[:-1]] = START if k == 2 else 0
        g = mix(mix(before, np.uint64(k)), tokens)
        if k > 2:
            g[place < k - 2] = 0
        grams.append(g)
    return first, grams


class Grams:
    """The distinct n-grams of a block, of the given orders, in one list sorted
    by hash."""

    def __init__(self, grams: list[np.ndarray], trained: np.ndarray, orders: range):
        self.places, self.index, hashes, counts, unigram = [], [], [], [], []
        base, self.n = 0, len(trained)
        for k in orders:
            g = grams[k - 1]
            valid = np.flatnonzero(g) if k > 2 else np.arange(len(g))
            distinct, index = np.unique(g[valid], return_inverse=True)
            self.places.append(valid)
            self.index.append(index + base)
            base += len(distinct)
            hashes.append(distinct)
            counts.append(np.bincount(index[trained[valid]], minlength=len(distinct)))
            unigram.append(np.full(len(distinct), k == 1))
        hashes = np.concatenate(hashes)
        self.order = np.argsort(hashes, kind="stable")
        self.hashes = hashes[self.order]
        # lowest bit: is it a single token
        self.counts = (np.concatenate(counts) << 1 | np.concatenate(unigram))[self.order]

    def per_place(self, totals: np.ndarray) -> list[np.ndarray]:
        """Totals given in the order of ``hashes`` -> per order, by token place."""
        unsorted = np.empty_like(totals)
        unsorted[self.order] = totals
        out = []
        for places, index in zip(self.places, self.index):
            t = np.zeros(self.n, dtype=np.int64)
            t[places] = unsorted[index]
            out.append(t)
        return out


def squeezed(values: np.ndarray) -> bytes:
    """Integers as compressed byte planes (small and rising values get short)."""
    planes = np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8).T)
    return len(values).to_bytes(8, "little") + pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def unsqueezed(data: bytes) -> np.ndarray:
    n = int.from_bytes(data[:8], "little")
    planes = np.frombuffer(pa.decompress(data[8:], 8 * n, codec="zstd", asbytes=True), dtype=np.uint8).reshape(8, n)
    return np.ascontiguousarray(planes.T).view("<u8").reshape(-1)


#: Tokens that one reading head of the automaton takes at most.
LANE = 512


class Automaton:
    """The part of the backoff automaton that a block's tokens can walk: states
    (0 is the root, 1 the start of a text, then the seen contexts), arcs sorted
    by (state, token), and a failure arc from each state to that of its suffix."""

    def __init__(self, first: np.ndarray, grams: list[np.ndarray], counts: list[np.ndarray], texts: int, tokens: int, types: int, strengths: tuple[float, ...]):
        """first: token range of each text; grams[k-1], counts[k-1]: hash and
        training count of the k-gram ending at each token; ``texts``, ``tokens``
        and ``types`` of training; strengths[k-2]: smoothing of order k."""
        self.first = first
        _, one, self.token = np.unique(grams[0], return_index=True, return_inverse=True)
        p = (counts[0] + 1.0) / (tokens + types + 1.0)
        self.base = np.log10(p)
        opening = np.zeros(len(p), dtype=bool)
        opening[first[:-1]] = True
        longest = len(strengths)  # words of the longest context
        self.order = longest + 1
        # the start is a state of its own; as a context of one word it fails to the root
        self.fail_to, self.fail_weight = [np.zeros(2, np.int64)], [np.array([0.0, np.log10(strengths[0] / (texts + strengths[0])) if longest and texts else 0.0])]
        # state of the context of each length that ends at each token (0: none longer than the root)
        ending, made = [np.zeros(len(p), np.int64)], 2
        for j in range(1, longest + 1):
            seen = np.flatnonzero(counts[j - 1] > 0)
            _, at, index = np.unique(grams[j - 1][seen], return_index=True, return_inverse=True)
            state = ending[-1].copy()  # where this length is not seen, the next shorter
            state[seen] = made + index
            self.fail_to.append(ending[-1][seen[at]])
            h = counts[j - 1][seen[at]].astype(np.float64)
            k = strengths[j - 1]
            self.fail_weight.append(np.log10(k / (h + k)))
            ending.append(state)
            made += len(at)
        keys, weights, targets = [], [], []
        for k in range(2, self.order + 1):
            context = np.zeros(len(p), np.int64)  # state of the k-1 tokens before
            context[1:] = ending[k - 1][:-1]
            h = np.zeros(len(p), np.int64)
            h[1:] = counts[k - 2][:-1]
            context[opening], h[opening] = (1, texts) if k == 2 else (0, 0)
            p = np.where(h > 0, (counts[k - 1] + strengths[k - 2] * p) / (h + strengths[k - 2]), p)
            taken = np.flatnonzero((counts[k - 1] > 0) & (h > 0))
            key, at = np.unique(context[taken] << 32 | self.token[taken], return_index=True)
            keys.append(key)
            weights.append(np.log10(p[taken[at]]))
            targets.append(ending[min(k, longest)][taken[at]])
        self.fail_to, self.fail_weight = np.concatenate(self.fail_to), np.concatenate(self.fail_weight)
        # the root has an arc for every token, known or not
        self.root_weight, self.root_to = self.base[one], ending[min(1, longest)][one]
        keys = np.concatenate([*keys, [np.int64(1) << 62]])
        order = np.argsort(keys, kind="stable")
        self.keys = keys[order]
        self.weights, self.targets = np.concatenate([*weights, [0.0]])[order], np.concatenate([*targets, [0]]).astype(np.int64)[order]

    def step(self, state: np.ndarray, token: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Reads one token in each of many states: the new states and the
        weights of the arcs taken, failures included."""
        weight, to = np.zeros(len(state)), np.empty_like(state)
        who = np.arange(len(state))
        state = state.copy()
        while len(who):
            at_root = state == 0
            done = who[at_root]
            weight[done] += self.root_weight[token[done]]
            to[done] = self.root_to[token[done]]
            who, state = who[~at_root], state[~at_root]
            key = state << 32 | token[who]
            arc = np.searchsorted(self.keys, key)
            hit = self.keys[arc] == key
            weight[who[hit]] += self.weights[arc[hit]]
            to[who[hit]] = self.targets[arc[hit]]
            who, state = who[~hit], state[~hit]
            weight[who] += self.fail_weight[state]
            state = self.fail_to[state]
        return to, weight

    def walk(self, lane: int = LANE) -> np.ndarray:
        """log10 probability of each text. A text of more than ``lane`` tokens
        is read by several heads, each of which starts ``order - 1`` tokens
        early at the root: after them it is in the state of a head that comes
        from the start, as a state is the longest seen suffix of that many."""
        size = np.diff(self.first)
        heads = -(-size // lane)
        text = np.repeat(np.arange(len(size)), heads)
        part = np.arange(len(text)) - np.repeat(np.cumsum(heads) - heads, heads)
        start = self.first[text] + part * lane
        end = np.minimum(start + lane, self.first[text + 1])
        at = np.maximum(start - (self.order - 1), self.first[text])
        by_length = np.argsort(at - end, kind="stable")  # longest first: those still reading are a prefix
        text, start, end, at = text[by_length], start[by_length], end[by_length], at[by_length]
        state = np.where(at == self.first[text], min(1, self.order - 1), 0)
        sums, length = np.zeros(len(text)), end - at
        for t in range(int(length[0]) if len(length) else 0):
            n = int(np.searchsorted(-length, -t, side="left"))  # heads with more than t tokens
            place = at[:n] + t
            state, weight = self.step(state[:n], self.token[place])
            sums[:n] += np.where(place >= start[:n], weight, 0.0)
        return np.bincount(text, weights=sums, minlength=len(size))


def lm_scores(docs: DataFrame, modulus: int = 7, held_out: int = 2, order: int = 3, strength: float | tuple[float, ...] = STRENGTHS, block_bytes: int = 4 << 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``
    for every row of ``docs``, learning from the rows whose crc32(id as text)
    mod ``modulus`` is not ``held_out``. ``strength`` is the smoothing k of all
    orders, or one for each order from 2 on.

    Null texts count as empty (one end token); a null id counts as '' for the
    split; repeated rows are counted and scored each; other columns are
    ignored; an empty table gives no rows. Tokens and n-grams are told apart
    by 64-bit hashes. Nothing is capped or pruned; the driver receives four
    numbers. A Python worker holds ``block_bytes`` of texts, or one longer text."""
    spark = docs.sparkSession
    scratch = Scratch(spark)
    strengths = tuple(strength) if isinstance(strength, (tuple, list)) else (strength,) * (order - 1)
    if len(strengths) != order - 1:
        raise ValueError(f"order {order} takes {order - 1} strengths, not {len(strengths)}")
    blocks = to_blocks(docs, scratch, id_col, text_col, block_bytes)

    def learned(rows) -> np.ndarray:
        return np.array([crc_mod_of(i, modulus) != held_out for i in rows.column("_id").to_pylist()], dtype=bool)

    # longer n-grams go in turns of their own: a turn's shuffle files go at its end
    turns = [range(1, min(order, 2) + 1), *(range(k, k + 1) for k in range(3, order + 1))]
    text_bytes = blocks.select(F.explode("keys.n_bytes").alias("n")).agg(F.sum("n")).first()[0] or 0

    def asking(orders: range):
        shards = shards_for(spark, len(orders) * text_bytes / 5, SHARD_GRAMS)
        cuts = np.array([i * (1 << 64) // shards for i in range(1, shards)], dtype=np.uint64)

        def asked(batches):
            for batch in batches:
                for block, payload in zip(batch.column("block").to_pylist(), batch.column("payload")):
                    rows = rows_of(payload.as_py())
                    first, grams = token_grams(texts_of(rows), orders[-1])
                    own = Grams(grams, np.repeat(learned(rows), np.diff(first)), orders)
                    at = np.concatenate(([0], np.searchsorted(own.hashes, cuts), [len(own.hashes)]))
                    full = np.flatnonzero(np.diff(at))
                    parts = [slice(at[i], at[i + 1]) for i in full.tolist()]
                    hashes = [squeezed(np.diff(own.hashes[p], prepend=np.uint64(0))) for p in parts]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(full, pa.int32()), pa.array(np.full(len(parts), block)), pa.array(hashes, pa.binary()), pa.array([squeezed(own.counts[p]) for p in parts], pa.binary())],
                        ["shard", "block", "grams", "counts"],
                    )

        return asked

    def answered(table):
        """Totals of a shard's n-grams, to each block in the order it asked;
        the first row also has the shard's training tokens and known words."""
        hashes = [np.cumsum(unsqueezed(g.as_py()), dtype=np.uint64) for g in table.column("grams")]
        counts = np.concatenate([unsqueezed(c.as_py()) for c in table.column("counts")]).astype(np.int64)
        distinct, first, index = np.unique(np.concatenate(hashes), return_index=True, return_inverse=True)
        totals = np.zeros(len(distinct), dtype=np.int64)
        np.add.at(totals, index, counts >> 1)
        words = totals[(counts[first] & 1).astype(bool)]
        ends = np.cumsum([len(h) for h in hashes])
        back = [squeezed(t) for t in np.split(totals[index], ends[:-1])]
        rest = [0] * (len(back) - 1)
        return pa.table({
            "block": table.column("block"), "shard": table.column("shard"), "totals": pa.array(back, pa.binary()),
            "tokens": pa.array([int(words.sum()), *rest], pa.int64()), "types": pa.array([int((words > 0).sum()), *rest], pa.int64()),
        })

    answers = None
    for turn, orders in enumerate(turns):
        questions = blocks.select("block", "payload").mapInArrow(tidy(asking(orders)), "shard int, block long, grams binary, counts binary")
        totals = questions.groupBy("shard").applyInArrow(answered, "block long, shard int, totals binary, tokens long, types long")
        del questions
        totals = scratch.table(totals, codec="uncompressed").withColumn("turn", F.lit(turn))
        answers = totals if answers is None else answers.unionByName(totals)
    scratch.release()
    tokens, types = (x or 0 for x in answers.agg(F.sum("tokens"), F.sum("types")).first())
    learns = F.crc32(F.coalesce(F.col("key.doc_id").cast("string"), F.lit("")).cast("binary")) % modulus != held_out
    train_docs = blocks.select(F.explode("keys").alias("key")).where(learns).count()

    def scored(batches):
        for batch in batches:
            for payload, turns_in, totals_in in zip(batch.column("payload"), batch.column("turns").to_pylist(), batch.column("totals")):
                rows = rows_of(payload.as_py())
                first, grams = token_grams(texts_of(rows), order)
                learn = learned(rows)
                trained, counts = np.repeat(learn, np.diff(first)), []
                for turn, orders in enumerate(turns):
                    totals = [unsqueezed(t.as_py()) for n, t in zip(turns_in, totals_in.values) if n == turn]
                    totals = np.concatenate([np.zeros(0, dtype=np.uint64), *totals]).astype(np.int64)
                    counts += Grams(grams, trained, orders).per_place(totals)
                automaton = Automaton(first, grams, counts, train_docs, tokens, types, strengths)
                add = lambda x: np.add.reduceat(x, first[:-1])
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column("_id"), pa.array(~learn), pa.array(np.diff(first)), pa.array(add((counts[0] > 0).astype(np.int64))),
                        pa.array(np.full(len(learn), tokens)), pa.array(add(automaton.base)), pa.array(automaton.walk()),
                    ],
                    ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
                )

    in_order = F.array_sort(F.collect_list(F.struct("turn", "shard", "totals")))
    packed = answers.groupBy("block").agg(in_order.alias("a")).select("block", F.col("a.turn").alias("turns"), F.col("a.totals").alias("totals"))
    joined = blocks.select("block", "payload").join(packed, "block").select("payload", "turns", "totals")
    return joined.mapInArrow(tidy(scored), "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
