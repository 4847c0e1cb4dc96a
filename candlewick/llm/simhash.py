"""SimHash near-duplicates by covering locality-sensitive hashing.

Every bit position gets a non-zero vector of r+1 bits; table v keeps the bits
whose vector has odd product with v. Any r positions leave some non-zero v
orthogonal to all their vectors, so two fingerprints that differ in at most r
bits agree on everything that table v keeps: no near pair is missed.

Copies share a fingerprint and count as one node. In a bucket only a spanning
set of its true links is emitted, and crowded buckets are split again by the
pigeonhole rule on the bits not fixed yet, so no pair list is ever built."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.llm.common import _LOWER, CHUNK, Scratch
from candlewick.llm.components import connected_components, spanning

BITS = 64
#: Buckets up to this size are compared directly.
DIRECT = 512
_TRANSLATE = _LOWER.tobytes()


def covering_masks(radius: int, bits: int = BITS) -> list[int]:
    """2^(radius+1) - 1 masks; any ``radius`` bits are left out by at least one."""
    span = (1 << (radius + 1)) - 1
    vector = [i % span + 1 for i in range(bits)]
    return [sum(1 << i for i in range(bits) if (vector[i] & v).bit_count() & 1) for v in range(1, span + 1)]


def fingerprint(text: bytes, shingle: int = 3, seed: int = 42) -> int:
    """Majority bits of the XXH64 values of the word shingles (repeats count)."""
    import xxhash

    words = text.translate(_TRANSLATE).split()
    if not words:
        return 0
    h = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return h(b" ".join(words), seed)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = len(words) - shingle + 1
    spans = zip(starts[:n].tolist(), ends[shingle - 1 :].tolist())
    counts, step = np.zeros(BITS, dtype=np.int64), 1 << 15
    for at in range(0, n, step):
        take = min(step, n - at)
        values = np.fromiter((h(joined[a:b], seed) for (a, b), _ in zip(spans, range(take))), dtype=np.uint64, count=take)
        bits = np.unpackbits(values.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int32)
    return sum(1 << i for i in np.flatnonzero(2 * counts > n).tolist())


def fingerprints(rows: DataFrame, shingle: int = 3, seed: int = 42) -> DataFrame:
    """Replaces the last column of ``rows``, a text, by its fingerprint ``fp``."""
    kept = rows.columns[:-1]

    def hashed(batches):
        import pyarrow as pa

        for batch in batches:
            texts = batch.column(len(kept)).cast(pa.binary()).to_pylist()
            fps = np.array([fingerprint(t or b"", shingle, seed) for t in texts], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(fps.view(np.int64), pa.int64())], [*kept, "fp"])

    return rows.mapInArrow(hashed, ", ".join(f"{c} long" for c in [*kept, "fp"]))


def close_pairs(fps: np.ndarray, radius: int, fixed: int, bits: int = BITS) -> tuple[list, list]:
    """Index pairs that connect all of ``fps`` (distinct, equal on the bits of
    ``fixed``) that lie within ``radius`` of each other; may leave out pairs
    that other pairs connect."""
    n = len(fps)
    if n <= DIRECT:
        near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= radius
        left, right = np.nonzero(np.triu(near, 1))
        return left.tolist(), right.tolist()
    free = [i for i in range(bits) if not fixed >> i & 1]
    left, right = [], []
    for g in range(radius + 1):
        part = sum(1 << i for i in free[g :: radius + 1])
        key = fps & np.uint64(part)
        order = np.argsort(key, kind="stable")
        cuts = np.flatnonzero(np.diff(key[order])) + 1
        for run in np.split(order, cuts):
            if len(run) > 1:
                a, b = close_pairs(fps[run], radius, fixed | part, bits)
                moved, top = spanning(len(run), a, b)
                left += run[moved].tolist()
                right += run[top].tolist()
    return left, right


def bucket_links(batches, radius: int, masks: list[int]):
    """Spanning links of every bucket of rows sorted by (band, key, fp)."""
    import pyarrow as pa

    held: list[np.ndarray] = []  # rows of the bucket that is still open

    def closed(rows: np.ndarray):
        band, key, fp = rows
        cuts = np.flatnonzero((band[1:] != band[:-1]) | (key[1:] != key[:-1])) + 1
        starts = np.concatenate(([0], cuts))
        sizes = np.diff(np.concatenate((starts, [len(fp)])))
        bits = fp.view(np.uint64)
        two = starts[sizes == 2]
        near = two[np.bitwise_count(bits[two] ^ bits[two + 1]) <= radius]
        a, b = [fp[near]], [fp[near + 1]]
        for s, n in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist()):
            moved, top = spanning(n, *close_pairs(bits[s : s + n], radius, masks[band[s]]))
            a.append(fp[s + moved])
            b.append(fp[s + top])
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(a), pa.int64()), pa.array(np.concatenate(b), pa.int64())], ["a", "b"])

    for batch in batches:
        rows = np.array([batch.column(c).to_numpy(zero_copy_only=False) for c in ("band", "key", "fp")], dtype=np.int64)
        if not rows.shape[1]:
            continue
        if held and (held[0][:2, 0] != rows[:2, 0]).any():
            yield closed(np.concatenate(held, axis=1))
            held = []
        same = (rows[0] == rows[0, -1]) & (rows[1] == rows[1, -1])
        last = rows.shape[1] - int(same[::-1].argmin()) if not same.all() else 0
        if last:
            yield closed(np.concatenate([*held, rows[:, :last]], axis=1))
            held = []
        held.append(rows[:, last:])
    if held:
        yield closed(np.concatenate(held, axis=1))


def components_of(hashed: DataFrame, radius: int, scratch: Scratch) -> DataFrame:
    """(fp, root): the fingerprint that names each fingerprint's component."""
    masks = covering_masks(radius)
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    nodes = scratch.table(hashed.select("fp").distinct())
    keyed = nodes.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in signed])).alias("band", "key"))
    buckets = keyed.repartition("band", "key").sortWithinPartitions("band", "key", "fp")
    links = buckets.select("band", "key", "fp").mapInArrow(lambda batches: bucket_links(batches, radius, masks), "a long, b long")
    roots = connected_components(links, scratch).withColumnRenamed("node", "fp")
    return nodes.join(roots, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"))


def simhash_components(docs: DataFrame, shingle: int = 3, radius: int = 3, seed: int = 42, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every row of ``docs``.

    Fingerprints that differ in at most ``radius`` bits link; component_id is
    the smallest id reachable. A text without words (null, empty, blank) has
    fingerprint zero and links like any other. Repeated rows give a row each;
    rows with null ids take part (a component whose ids are all null has a null
    component_id); other columns are ignored; an empty table gives no rows."""
    scratch = Scratch(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    hashed = scratch.table(fingerprints(rows, shingle, seed))
    firsts = hashed.groupBy("fp").agg(F.min("doc_id").alias("first"))
    rooted = components_of(hashed, radius, scratch).join(firsts, "fp")
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = rooted.join(smallest, "root").select("fp", "component_id")
    return hashed.join(named, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, shingle: int = 3, radius: int = 3, seed: int = 42, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: of each component
    the one with the smallest id (null ids last, then the first row as read),
    exactly one row of a component even where rows repeat."""
    scratch = Scratch(docs.sparkSession)
    renamed = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    numbered = scratch.chunked(renamed)
    at = {name: f"c{i}" for i, name in enumerate(docs.columns)}
    row = F.col("_chunk") * CHUNK + F.col("_bit")
    rows = numbered.select(row.alias("row"), F.col(at[id_col]).cast("long").alias("doc_id"), F.col(at[text_col]).cast("string").alias("text"))
    hashed = scratch.table(fingerprints(rows, shingle, seed))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row")).alias("first")
    per_fp = hashed.groupBy("fp").agg(first)
    rooted = components_of(hashed, radius, scratch).join(per_fp, "fp")
    stays = rooted.groupBy("root").agg(F.min("first").alias("first")).select(F.col("first.row").alias("row"))
    # one bitmap per chunk says which of its rows stay
    bits = stays.groupBy(F.floor(F.col("row") / CHUNK).alias("_chunk")).agg(F.bitmap_construct_agg(F.col("row") % CHUNK).alias("_stay"))
    bits = scratch.table(bits).hint("shuffle_hash")
    byte = F.conv(F.hex(F.substring("_stay", F.floor(F.col("_bit") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    kept = numbered.join(bits, "_chunk").where(byte.bitwiseAND(F.call_function("shiftleft", F.lit(1), F.col("_bit") % 8)) != 0)
    return kept.select(*renamed.columns).toDF(*docs.columns)
