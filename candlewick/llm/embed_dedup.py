"""Embedding near-duplicates by an exact metric range join.

cosine >= t on unit vectors is Euclidean distance <= r = sqrt(2 - 2t). Pivots
split the vectors of a label into cells (nearest pivot). By the triangle
inequality a vector can only have a partner in another cell if it lies within
r of the plane between the two pivots: it is replicated into those cells (of
lower number, so that a pair meets once), and cells then join independently.
Inside a cell, vectors sorted by distance to the pivot are only compared where
these distances differ by at most r.

Equal vectors are one node with a weight. A cell beyond ``block`` vectors is
joined block against block by separate tasks; a task returns link counts and a
spanning set of links, never the pairs."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.llm.common import Scratch
from candlewick.llm.components import connected_components, spanning

#: Slack on distances against rounding; pairs are decided by their cosine.
SLACK = 1e-6


def links_in(vectors: np.ndarray, weights: np.ndarray, home: np.ndarray, side: np.ndarray, ring: np.ndarray, radius: float, cosine: float):
    """Per row the weight of its linked rows, and index pairs connecting all
    links. Rows of side 0 and 1 are compared with each other (all with all
    when there is one side); two replicas (not ``home``) are never compared."""
    order = np.argsort(ring, kind="stable")
    vectors, weights, home, side, ring = vectors[order], weights[order], home[order], side[order], ring[order]
    norms = np.sqrt(np.einsum("ij,ij->i", vectors, vectors))
    n, both = len(ring), bool(side.any() and not side.all())
    sums, left, right = np.zeros(n, dtype=np.int64), [], []
    step = 512
    for at in range(0, n, step):
        rows = slice(at, min(n, at + step))
        stop = int(np.searchsorted(ring, ring[rows.stop - 1] + radius + SLACK, "right"))
        for to in range(at, stop, step):
            cols = slice(to, min(stop, to + step))
            cos = (vectors[rows] @ vectors[cols].T) / (norms[rows, None] * norms[None, cols])
            near = (cos >= cosine) & (home[rows, None] | home[None, cols])
            if both:
                near &= side[rows, None] != side[None, cols]
            if to == at:
                near = np.triu(near, 1)
            if not near.any():
                continue
            sums[rows] += near @ weights[cols]
            sums[cols] += weights[rows] @ near
            a, b = np.nonzero(near)
            moved, top = spanning(rows.stop - at + cols.stop - to, a.tolist(), (b + rows.stop - at).tolist())
            place = np.concatenate([np.arange(at, rows.stop), np.arange(to, cols.stop)])
            left.append(place[moved])
            right.append(place[top])
    a = np.concatenate(left) if left else np.empty(0, dtype=np.int64)
    b = np.concatenate(right) if right else a
    moved, top = spanning(n, a.tolist(), b.tolist())
    out = np.empty(n, dtype=np.int64)
    out[order] = sums
    return out, order[moved], order[top]


def embedding_components(vectors: DataFrame, cosine: float = 0.98, pivots: int | None = None, block: int = 4096, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``vectors``.

    Rows link when their labels and dimensions are equal, the label is not null
    and the cosine in double precision is at least ``cosine``. Vectors that are
    null, empty, zero or hold null or non-finite components, and rows without a
    label, link with nothing. Repeated rows are vectors of their own; a null id
    never is the smallest unless a component has no other; ``kept`` is then
    true for rows whose id equals it (null-safe). Other columns are ignored.

    ``pivots``: how many vectors (lowest hashes, so a bounded sample of the
    given size) split the labels that have more than ``block`` of them; by
    default one per 8 * block distinct vectors, 4 to 512. They only decide who
    meets where; every pair within the radius is compared."""
    spark = vectors.sparkSession
    scratch = Scratch(spark)
    vec = F.col(vector_col).cast("array<double>")
    big = F.lit(float("inf"))
    fine = F.col(label_col).isNotNull() & vec.isNotNull() & (F.size(vec) > 0)
    fine &= F.coalesce(F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < big)) & F.exists(vec, lambda x: x != 0), F.lit(False))
    rows = vectors.select(
        F.col(id_col).cast("long").alias("vec_id"),
        F.when(fine, F.col(label_col).cast("string")).alias("label"),
        F.when(fine, F.col(vector_col)).alias("vec"),
    )
    nodes = rows.where("vec is not null").groupBy("label", "vec").agg(F.count("*").alias("weight"), F.min("vec_id").alias("first"))
    nodes = scratch.table(nodes.withColumn("node", F.monotonically_increasing_id()))
    labels = nodes.groupBy("label", F.size("vec").alias("dim")).agg(F.count("*").alias("size"))
    sized = nodes.withColumn("dim", F.size("vec")).join(labels, ["label", "dim"])
    total = nodes.count()
    count = pivots or min(512, max(4, total // (8 * block)))
    sample = nodes.select(F.xxhash64("vec").alias("h"), "vec").orderBy("h", "node").limit(count).collect()  # `count` vectors
    by_dim: dict[int, np.ndarray] = {}
    for r in sample:
        v = np.array(r["vec"], dtype=np.float64)
        by_dim.setdefault(len(v), []).append(v / np.linalg.norm(v))
    by_dim = {d: np.array(v) for d, v in by_dim.items()}
    radius = float(np.sqrt(max(0.0, 2 - 2 * cosine)))

    def assigned(batches):
        import pyarrow as pa

        names = ["label", "dim", "cell", "home", "node", "weight", "ring", "vec"]
        for batch in batches:
            dims, sizes = batch.column("dim").to_numpy(), batch.column("size").to_numpy()
            vecs, parts = batch.column("vec"), []
            for d in np.unique(dims):
                index = np.flatnonzero(dims == d)
                v = np.array(vecs.take(pa.array(index)).values.to_numpy(zero_copy_only=False), dtype=np.float64).reshape(-1, d)
                base, far = by_dim.get(int(d)), sizes[index] > block
                unit = v / np.sqrt(np.einsum("ij,ij->i", v, v))[:, None]
                if base is None:
                    base = np.eye(1, d)
                dist = np.sqrt(np.maximum(0, 2 - 2 * unit @ base.T))
                dist[~far, 1:] = np.inf  # small labels stay whole
                best = dist.argmin(axis=1)
                near = dist[np.arange(len(index)), best]
                apart = np.sqrt(np.maximum(1e-300, 2 - 2 * base @ base.T))
                with np.errstate(invalid="ignore"):
                    off = (dist**2 - near[:, None] ** 2) / (2 * apart[best])
                goes = (off <= radius + SLACK) & (np.arange(len(base))[None, :] < best[:, None])
                goes[np.arange(len(index)), best] = True
                who, cell = np.nonzero(goes)
                parts.append((index[who], cell, cell == best[who], dist[who, cell]))
            if not parts:
                continue
            who, cell, home, ring = (np.concatenate(x) for x in zip(*parts))
            take = pa.array(who)
            yield pa.RecordBatch.from_arrays(
                [batch.column("label").take(take), batch.column("dim").take(take), pa.array(cell, pa.int32()), pa.array(home), batch.column("node").take(take), batch.column("weight").take(take), pa.array(ring, pa.float64()), vecs.take(take)],
                names,
            )

    kind = nodes.schema["vec"].dataType.simpleString()
    cells = scratch.table(sized.select("label", "dim", "size", "node", "weight", "vec").mapInArrow(assigned, f"label string, dim int, cell int, home boolean, node long, weight long, ring double, vec {kind}"))
    key = ["label", "dim", "cell"]
    blocks = cells.groupBy(*key).agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    dealt = (
        cells.join(blocks, key)
        .withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(*key, F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), (F.col("own") > F.col("other")).cast("int").alias("side"), "home", "node", "weight", "ring", "vec")
    )

    def joined(table):
        import pyarrow as pa

        d = table.column("dim")[0].as_py()
        flat = table.column("vec").combine_chunks()
        v = np.array(flat.flatten().to_numpy(zero_copy_only=False), dtype=np.float64).reshape(-1, d)
        node, weight, home, side, ring = (table.column(c).to_numpy() for c in ("node", "weight", "home", "side", "ring"))
        sums, a, b = links_in(v, weight, home, side, ring, radius, cosine)
        linked = np.flatnonzero(sums)
        return pa.table({
            "a": pa.array(np.concatenate([node[linked], node[a]]), pa.int64()),
            "b": pa.array(np.concatenate([node[linked], node[b]]), pa.int64()),
            "links": pa.array(np.concatenate([sums[linked], np.zeros(len(a), dtype=np.int64)]), pa.int64()),
        })

    found = scratch.table(dealt.groupBy(*key, "i", "j").applyInArrow(joined, "a long, b long, links long"))
    sums = found.where("links > 0").groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    roots = connected_components(found.where("links = 0").select("a", "b"), scratch)
    rooted = nodes.join(roots, "node", "left").select("node", "first", F.coalesce("root", "node").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    facts = rooted.join(smallest, "root").select("node", "component_id")
    facts = nodes.join(facts, "node").join(sums, "node", "left").select("label", "vec", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), "component_id")
    good, rest = rows.where("vec is not null"), rows.where("vec is null")
    out = good.join(facts, ["label", "vec"]).select("vec_id", "n_links", "component_id")
    out = out.union(rest.select("vec_id", F.lit(0).cast("long"), "vec_id"))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
