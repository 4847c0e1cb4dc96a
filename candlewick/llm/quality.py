"""Quality classifier: supervised subword embeddings.

A document is the average of learned vectors of its hashed words, word pairs
and character n-grams; a softmax layer on it gives the class. Training is plain
numpy stochastic gradient descent over a bounded sample of labelled rows, whose
features are written as a table and streamed through one task; only the trained
numbers come to the driver. Because average and layer are linear, a trained
feature contributes one number to the log-odds: scoring sums these numbers over
a whole text, without caps."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.llm.common import Scratch, Words, crc_mod, mix

_M = [np.uint32(x) for x in (0x85EBCA6B, 0xC2B2AE35, 0x27D4EB2F, 0x165667B1, 0x9E3779B1)]


def features(texts: list[str], bits: int, sizes: tuple[int, ...] = (2, 3, 4)):
    """Yields (feature ids, bounds): the features of text i are
    ids[bounds[i]:bounds[i+1]]. Words are hashed as they are, and so are pairs
    of neighbouring words; "the same word again" is one more feature (id 0,
    whatever the word); character n-grams run over code points, white space
    included."""
    words = Words([t.encode() for t in texts], lower=False)
    yield (words.hashes >> np.uint64(64 - bits)).astype(np.int64), words.first
    paired = np.ones(len(words.hashes), dtype=bool)  # has a next word in its text
    paired[words.first[1:][words.first[1:] > 0] - 1] = False
    pairs = mix(words.hashes[:-1], words.hashes[1:])[paired[:-1]]
    yield (pairs >> np.uint64(64 - bits)).astype(np.int64), np.concatenate(([0], np.cumsum(paired)))[words.first]
    again = np.append(words.hashes[1:] == words.hashes[:-1], False)[: len(paired)] & paired
    yield np.zeros(int(again.sum()), dtype=np.int64), np.concatenate(([0], np.cumsum(again)))[words.first]
    code = np.frombuffer("".join(texts).encode("utf-32-le"), dtype=np.uint32)
    length = np.fromiter(map(len, texts), np.int64, len(texts))
    start = np.concatenate(([0], np.cumsum(length)))
    for n in sizes:
        m = max(0, len(code) - n + 1)
        h = np.full(m, n, dtype=np.uint32)
        for k in range(n):
            h = h * _M[k] + code[k : k + m]
            h ^= h >> np.uint32(15)
        h *= _M[4]
        ids = (h >> np.uint32(32 - bits)).astype(np.int64)
        # drop the n-grams that run into the next text
        ok = np.ones(m, dtype=bool)
        for k in range(1, n):
            cross = start[1:-1] - k
            ok[cross[(cross >= 0) & (cross < m)]] = False
        ids = ids[ok]
        yield ids, np.concatenate(([0], np.cumsum(ok)))[np.minimum(start, m)]


def bag(text: str, bits: int) -> tuple[np.ndarray, np.ndarray]:
    ids = np.concatenate([ids for ids, _ in features([text], bits)])
    return np.unique(ids, return_counts=True)


class Model:
    """Embeddings (2^bits, dim), softmax weights (dim, 2) and bias, trained by
    stochastic gradient descent, one document at a time with Adagrad step
    sizes. ``share`` weighs the two classes."""

    def __init__(self, bits: int, share: tuple[float, float], dim: int = 8, rate: float = 0.3, seed: int = 1):
        rnd = np.random.default_rng(seed)
        self.vectors = (rnd.random((1 << bits, dim), dtype=np.float32) - np.float32(0.5)) / dim
        self.out = (rnd.random((dim, 2), dtype=np.float32) - np.float32(0.5)) / dim
        self.bias = np.zeros(2, dtype=np.float32)
        self.seen, self.out_seen, self.bias_seen = np.full(1 << bits, 1e-8, dtype=np.float32), np.full((dim, 2), 1e-4), np.full(2, 1e-2)
        self.share, self.rate, self.dim = share, rate, dim

    def learn(self, ids: np.ndarray, counts: np.ndarray, label: int) -> None:
        if not len(ids):
            return
        weight = (counts / counts.sum()).astype(np.float32)
        hidden = weight @ self.vectors[ids]
        z = hidden @ self.out + self.bias
        p = np.exp(z - z.max())
        p /= p.sum()
        p[label] -= 1
        p *= self.share[label]
        back = self.out @ p
        step = np.outer(hidden, p)
        self.out_seen += step**2
        self.bias_seen += p**2
        self.seen[ids] += weight**2 * (back @ back) / self.dim
        self.vectors[ids] -= (self.rate * weight / np.sqrt(self.seen[ids]))[:, None] * back
        self.out -= self.rate * step / np.sqrt(self.out_seen)
        self.bias -= 0.1 * self.rate * p / np.sqrt(self.bias_seen)

    def numbers(self) -> tuple[np.ndarray, float]:
        """What each feature adds to the log-odds of label 1, and the bias."""
        return (self.vectors @ (self.out[:, 1] - self.out[:, 0])).astype(np.float32), float(self.bias[1] - self.bias[0])


def train(bags: DataFrame, teach: dict[int, int], bits: int, epochs: int = 3) -> tuple[np.ndarray, float]:
    """Numbers of a model that has read the rows (h, label, ids, counts) of
    ``bags`` once per epoch, each time in another order. ``teach``: rows of
    each label. One task reads the table and sorts what it reads (it may
    spill); its Python worker holds the model and one Arrow batch."""
    share = tuple(sum(teach.values()) / (2.0 * teach[c]) for c in (0, 1))

    def trained(batches):
        model = Model(bits, share)
        for batch in batches:
            for label, ids, counts in zip(batch.column("label").to_pylist(), batch.column("ids"), batch.column("counts")):
                model.learn(np.frombuffer(ids.as_py(), "<i4"), np.frombuffer(counts.as_py(), "<i4"), label)
        weights, prior = model.numbers()
        yield pa.RecordBatch.from_arrays([pa.array([weights.tobytes()], pa.binary()), pa.array([prior])], ["weights", "prior"])

    turns = bags.coalesce(1).withColumn("epoch", F.explode(F.array(*[F.lit(e) for e in range(epochs)])))
    turns = turns.sortWithinPartitions("epoch", F.xxhash64("h", "epoch"), "h").select("label", "ids", "counts")
    row = turns.mapInArrow(trained, "weights binary, prior double").collect()[0]
    return np.frombuffer(row["weights"], np.float32), row["prior"]


def quality_scores(docs: DataFrame, labels: DataFrame, modulus: int = 4, held_out: int = 2, threshold: float = 0.7, examples: int = 1500, bits: int = 17, id_col: str = "doc_id", text_col: str = "text", keep_good: bool = False) -> DataFrame:
    """``doc_id, held_out, score, predicted`` per row of ``docs``; with
    ``keep_good`` the rows themselves, those with ``predicted`` 1.

    Learns from at most ``examples`` labelled documents of each class (lowest
    id hashes among those whose crc32(id as text) mod ``modulus`` is not
    ``held_out``; a documented bound of the training only). Null labels and
    ids don't teach; an id with both labels counts as 0. Null and empty texts
    get the bias alone; without labels of both classes every score is the
    smoothed share of label 1. Repeated rows are scored each, an empty table
    gives no rows, and other columns are ignored (or kept, with ``keep_good``).
    A text is read whole, however long; about a million characters, or one
    longer text, are scored at a time. Of a training text only the counts of
    its at most 2^``bits`` features are kept, in a scratch table."""
    spark = docs.sparkSession
    scratch = Scratch(spark)
    marks = labels.where("doc_id is not null and quality in (0, 1)").groupBy(F.col("doc_id").cast("long").alias("_id")).agg(F.min("quality").cast("int").alias("_label"))
    marks = marks.where(crc_mod("_id", modulus) != held_out).withColumn("_h", F.xxhash64("_id"))
    # a join with the documents first: labels of absent ones must not use up the bound
    ids = docs.select(F.col(id_col).cast("long").alias("_id")).distinct()
    here = marks.join(ids, "_id", "left_semi")
    chosen = here.where("_label = 0").orderBy("_h", "_id").limit(examples).union(here.where("_label = 1").orderBy("_h", "_id").limit(examples))
    chosen = spark.createDataFrame(chosen.collect(), chosen.schema)  # 2 * examples rows
    texts = docs.select(F.col(id_col).cast("long").alias("_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text"))

    def bagged(batches):
        for batch in batches:
            bags = [bag(t, bits) for t in batch.column("_text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("_h"), batch.column("_label"), pa.array([b[0].astype("<i4").tobytes() for b in bags], pa.binary()), pa.array([b[1].astype("<i4").tobytes() for b in bags], pa.binary())],
                ["h", "label", "ids", "counts"],
            )

    # one text per id (the least, where rows repeat an id with other texts)
    picked = texts.join(F.broadcast(chosen), "_id").groupBy("_id", "_h", "_label").agg(F.min("_text").alias("_text")).select("_h", "_label", "_text")
    bags = scratch.table(picked.mapInArrow(bagged, "h long, label int, ids binary, counts binary"))
    n = {0: 0, 1: 0, **{r["label"]: r["count"] for r in bags.groupBy("label").count().collect()}}
    if all(n.values()):
        weights, prior = train(bags, n, bits)
    else:
        weights = np.zeros(1 << bits, dtype=np.float32)
        prior = float(np.log((n[1] + 1) / (n[0] + 1)))
    scratch.drop(bags)

    def log_odds(texts: list[str]) -> np.ndarray:
        total, count = np.zeros(len(texts)), np.zeros(len(texts))
        for ids, bounds in features(texts, bits):
            sums = np.concatenate(([0.0], np.cumsum(weights[ids], dtype=np.float64)))
            total += sums[bounds[1:]] - sums[bounds[:-1]]
            count += np.diff(bounds)
        return prior + total / np.maximum(1, count)

    def scored(batches):
        for batch in batches:
            texts = batch.column(text_at).cast(pa.string()).fill_null("").to_pylist()
            z, at = np.empty(len(texts)), 0
            while at < len(texts):  # about a million characters at a time
                to, size = at, 0
                while to < len(texts) and (to == at or size + len(texts[to]) <= 1 << 20):
                    size += len(texts[to])
                    to += 1
                z[at:to] = log_odds(texts[at:to])
                at = to
            p = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], pa.array(p), pa.array((p >= threshold).astype(np.int32))], [*kept, "score", "predicted"])

    if keep_good:
        renamed = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
        text_at, kept = docs.columns.index(text_col), renamed.columns
        schema = ", ".join(f"c{i} {f.dataType.simpleString()}" for i, f in enumerate(docs.schema))
        rated = renamed.mapInArrow(scored, f"{schema}, score double, predicted int")
        return rated.where("predicted = 1").select(*kept).toDF(*docs.columns)
    kept, text_at = ["doc_id", "held_out"], 2
    split = (crc_mod(id_col, modulus) == held_out).alias("held_out")
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), split, F.col(text_col).cast("string").alias("text"))
    return narrow.mapInArrow(scored, "doc_id long, held_out boolean, score double, predicted int")
