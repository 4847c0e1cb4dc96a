"""Exact top-k inner products: norm-sorted search with SVD-rotated partial sums.

Candidates are read in blocks of falling length. A block is skipped for a
query when |q| times its greatest length cannot reach the query's k-th score;
inside a block, the product over the leading directions of a rotation plus the
Cauchy-Schwarz bound on the rest decides who gets an exact integer product.
The rotation (singular vectors of a bounded sample) only affects speed.

Query blocks meet candidate blocks by an equi-join of keys (a query block and
a stripe of candidate blocks); a task streams its stripe and holds one block of
either side and k results per query."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candlewick.llm.common import Scratch

#: Tile of candidates scored at once.
TILE = 512


def integers(vectors: np.ndarray, scale: float) -> np.ndarray:
    return np.floor(scale * vectors.astype(np.float64)).astype(np.int64)


def products(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact integer products: float64 where every sum stays below 2^53, 64-bit
    integers below 2^63; beyond, an error rather than a score that wraps."""
    top = np.abs(q.astype(np.float64)).max(initial=0) * np.abs(c.astype(np.float64)).max(initial=0) * q.shape[1]
    if top >= 2.0**63:
        raise OverflowError("inner products of these vectors may not fit a long: use a smaller scale")
    if top < 2**53:
        return (q.astype(np.float64) @ c.T.astype(np.float64)).astype(np.int64)
    return q @ c.T


class Best:
    """The k best (score, smaller id) per query, kept as flat sorted arrays."""

    def __init__(self, n: int, k: int):
        self.n, self.k = n, k
        self.q = self.score = self.vec = self.row = np.empty(0, dtype=np.int64)
        self.null = np.empty(0, dtype=bool)
        self.floor = np.full(n, -np.inf)

    def add(self, q, score, vec, null, row):
        q, score, vec = (np.concatenate(x) for x in ((self.q, q), (self.score, score), (self.vec, vec)))
        null, row = np.concatenate((self.null, null)), np.concatenate((self.row, row))
        by = np.lexsort((row, vec, null, -score, q))
        q = q[by]
        starts = np.searchsorted(q, np.arange(self.n))
        keep = np.arange(len(q)) - starts[q] < self.k
        by, self.q = by[keep], q[keep]
        self.score, self.vec, self.null, self.row = score[by], vec[by], null[by], row[by]
        starts = np.searchsorted(self.q, np.arange(self.n + 1))
        full = np.diff(starts) == self.k
        self.floor[full] = self.score[starts[1:][full] - 1]


def search(best: Best, q: dict, c: dict, head: int) -> None:
    """Feeds ``best`` with every candidate of block ``c`` that may count.
    Blocks: ``ints``, ``row``, ``norm``, ``lead`` and ``rest`` (leading
    coordinates and length of the others after rotation)."""
    n, at = len(c["row"]), 0
    while at < n:
        size = TILE if np.isfinite(best.floor).all() else 32
        tile = slice(at, min(n, at + size))
        at = tile.stop
        slack = 1e-9 * q["norm"] * c["norm"][tile].max() + 1e-3
        live = np.flatnonzero(q["norm"] * c["norm"][tile].max() + slack >= best.floor)
        if not len(live):
            if (q["norm"] * c["norm"][tile].max() + slack < best.floor).all() and c["sorted"]:
                return  # lengths only fall from here
            continue
        bound = q["lead"][live] @ c["lead"][tile].T + q["rest"][live, None] * c["rest"][None, tile]
        may = bound + slack[live, None] >= best.floor[live, None]
        rows, cols = may.any(axis=1), may.any(axis=0)
        if not rows.any():
            continue
        who, which = live[rows], np.flatnonzero(cols) + tile.start
        score = products(q["ints"][who], c["ints"][which])
        good = may[np.ix_(rows, cols)] & (score >= best.floor[who, None]) & (q["row"][who, None] != c["row"][None, which])
        a, b = np.nonzero(good)
        if len(a):
            best.add(who[a], score[a, b], c["vec"][which[b]], c["null"][which[b]], c["row"][which[b]])


def block_of(batch_rows: dict, basis: np.ndarray, head: int) -> dict:
    ints = batch_rows["ints"]
    turned = ints @ basis
    rest = np.sqrt(np.maximum(0, (turned[:, head:] ** 2).sum(axis=1)))
    return batch_rows | {"norm": np.sqrt((turned**2).sum(axis=1)), "lead": turned[:, :head], "rest": rest, "sorted": True}


def top_inner_products(vectors: DataFrame, k: int = 5, every: int = 50, scale: float = 256.0, head: int = 16, sample: int = 2048, query_block: int = 8192, block: int = 2048, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: for every row whose id is divisible by
    ``every``, its ``k`` greatest integer inner products with all other rows of
    its dimension (components are floor(scale * x)); ties go to the smaller id
    (null ids last, then any of equal rows). Fewer rows than k: all of them.

    Rows whose vector is null or holds null or non-finite components take no
    part; empty vectors neither; repeated rows are rows of their own, so a
    repeated query id returns one list per row. Other columns are ignored.
    Finite components so large that a scaled one, or a product by the bound
    max|q| max|c| d, leaves the range of a long end the query with an error."""
    spark = vectors.sparkSession
    scratch = Scratch(spark)
    x = F.col(vector_col).cast("array<double>")
    fine = x.isNotNull() & (F.size(x) > 0) & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    beyond = F.raise_error(F.lit("a scaled component does not fit a long: use a smaller scale")).cast("long")
    ints = F.transform(x, lambda v: F.when(F.abs(F.lit(scale) * v) < F.lit(2.0**63), F.floor(F.lit(scale) * v).cast("long")).otherwise(beyond))
    rows = vectors.where(F.coalesce(fine, F.lit(False))).select(F.col(id_col).cast("long").alias("vec"), ints.alias("ints"))
    length = F.aggregate("ints", F.lit(0.0), lambda s, v: s + v.cast("double") * v.cast("double"))
    rows = scratch.table(rows.withColumn("row", F.monotonically_increasing_id()).withColumn("dim", F.size("ints")).withColumn("length", length))
    facts = rows.groupBy("dim").agg(F.count("*").alias("n"), F.sum((F.col("vec") % every == 0).cast("long")).alias("queries")).collect()  # one row per dimension
    counts = {r["dim"]: (r["n"], r["queries"] or 0) for r in facts}
    bases = {}
    for d in counts:
        some = rows.where(F.col("dim") == d).orderBy(F.xxhash64("ints"), "row").limit(sample).select("ints").collect()  # `sample` vectors
        m = np.array([r["ints"] for r in some], dtype=np.float64)
        bases[d] = np.linalg.svd(m, full_matrices=True)[2].T
    wide = int(spark.conf.get("spark.sql.shuffle.partitions"))

    # blocks of falling length, cut inside range partitions
    number = F.row_number().over(Window.partitionBy("part").orderBy(F.desc("length"), "row")) - 1
    ranged = rows.repartitionByRange(max(1, sum(n for n, _ in counts.values()) // (4 * block) + 1), "dim", F.desc("length"), "row")
    blocks = (
        ranged.withColumn("part", F.spark_partition_id())
        .withColumn("cut", F.floor(number / block))
        .groupBy("dim", "part", "cut")
        .agg(F.max("length").alias("longest"), F.collect_list(F.struct("length", "row", "vec", "ints")).alias("rows"))
        .withColumn("rows", F.reverse(F.array_sort("rows")))
    )
    blocks = scratch.table(blocks)
    stripes = {d: max(1, min(-(-n // block), wide * 2 // max(1, -(-q // query_block)))) for d, (n, q) in counts.items()}
    parts = {d: max(1, -(-q // query_block)) for d, (_, q) in counts.items()}

    def lookup(table: dict):
        return F.create_map(*[F.lit(v) for item in table.items() for v in item])[F.col("dim")] if table else F.lit(1)

    queries = (
        rows.where(F.col("vec") % every == 0)
        .withColumn("qblock", F.pmod(F.xxhash64("row"), lookup(parts)).cast("int"))
        .groupBy("dim", "qblock")
        .agg(F.collect_list(F.struct("length", "row", "vec", "ints")).alias("rows"))
    )
    # longest blocks first in every stripe
    placed = blocks.withColumn("stripe", F.pmod(F.xxhash64("part", "cut"), lookup(stripes)).cast("int"))
    side_c = placed.withColumn("qblock", F.explode(F.sequence(F.lit(0), lookup(parts) - 1))).select("dim", "qblock", "stripe", F.lit(1).alias("kind"), "longest", "rows")
    side_q = queries.withColumn("stripe", F.explode(F.sequence(F.lit(0), lookup(stripes) - 1))).select("dim", "qblock", "stripe", F.lit(0).alias("kind"), F.lit(0.0).alias("longest"), "rows")
    met = side_q.union(side_c).repartition("dim", "qblock", "stripe").sortWithinPartitions("dim", "qblock", "stripe", "kind", F.desc("longest"))

    def searched(batches):
        key = q = best = None

        def result():
            row = pa.array(q["row"][best.q])
            query = pa.array(q["vec"][best.q])
            vec = pa.array(best.vec, mask=best.null)
            return pa.RecordBatch.from_arrays([row, query, vec, pa.array(best.row), pa.array(best.score)], ["qrow", "query_id", "vec_id", "row", "score"])

        for batch in batches:
            for i in range(batch.num_rows):
                d, *rest = now = tuple(batch.column(c)[i].as_py() for c in ("dim", "qblock", "stripe"))
                entry = batch.column("rows").slice(i, 1).flatten()
                vec = entry.field("vec")
                got = {
                    "row": entry.field("row").to_numpy(zero_copy_only=False),
                    "vec": vec.fill_null(0).to_numpy(zero_copy_only=False),
                    "null": np.array(vec.is_null()),
                    "ints": entry.field("ints").flatten().to_numpy(zero_copy_only=False).reshape(-1, d),
                }
                got = block_of(got, bases[d], min(head, d))
                if batch.column("kind")[i].as_py() == 0:
                    if best is not None:
                        yield result()
                    key, q, best = now, got, Best(len(got["row"]), k)
                elif now == key:
                    search(best, q, got, head)
        if best is not None:
            yield result()

    found = met.select("dim", "qblock", "stripe", "kind", "rows").mapInArrow(searched, "qrow long, query_id long, vec_id long, row long, score long")
    order = Window.partitionBy("qrow").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "row")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
