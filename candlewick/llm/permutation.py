"""Approximate nearest neighbours by a permutation index.

Every vector is represented by its ``stored`` nearest pivots in order. Blocks
of vectors hold inverted files: per pivot, who has it and at which place. A
query goes through the files of its own ``asked`` nearest pivots and sums the
footrule, the distance of the places (a pivot that a vector doesn't have
counts as the place behind its last). The vectors of a block with the smallest
footrule, ties included, are ranked again by their exact distance.

Equal vectors are one node of the index with its smallest ids, so a group of
copies of any size is stored, asked and searched once. The index is a table
with a row per block; queries are dealt out to the blocks by key, and a task
holds one block and streams the queries through it."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candlewick.llm.common import Scratch, shards_for


def nearest_pivots(vectors: np.ndarray, pivots: np.ndarray, count: int) -> np.ndarray:
    """Indexes of the ``count`` nearest pivots of every vector, nearest first."""
    with np.errstate(over="ignore", invalid="ignore"):
        far = np.nan_to_num(np.einsum("ij,ij->i", pivots, pivots)[None] - 2 * vectors @ pivots.T)
    if count < len(pivots):
        some = np.argpartition(far, count - 1, axis=1)[:, :count]
        order = np.lexsort((some, np.take_along_axis(far, some, axis=1)), axis=1)
        return np.take_along_axis(some, order, axis=1)
    return np.argsort(far, axis=1, kind="stable")


def distances(query: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Euclidean distances in double precision, scaled where squares would
    leave its range; a distance beyond the range itself is infinite."""
    with np.errstate(over="ignore", invalid="ignore"):
        apart = vectors - query
        out = np.sqrt(np.einsum("ij,ij->i", apart, apart))
        for i in np.flatnonzero(~np.isfinite(out) | (out < 1e-150)):
            top = np.abs(apart[i]).max()
            out[i] = top * np.sqrt(((apart[i] / top) ** 2).sum()) if 0 < top < np.inf else top
    return out


#: Columns of an index block.
INDEX = "vec array<double>, node array<long>, first array<long>, member array<int>, place array<int>, start array<int>"


def matrix(column: pa.ChunkedArray, d: int) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


class InvertedFiles:
    """Per pivot the members of a block that have it, and its place in each."""

    def __init__(self, n: int, stored: int, member: np.ndarray, place: np.ndarray, start: np.ndarray):
        self.n, self.stored, self.member, self.place, self.start = n, stored, member, place, start

    @classmethod
    def of(cls, orders: np.ndarray, pivots: int) -> "InvertedFiles":
        n, stored = orders.shape
        flat = orders.ravel()
        by = np.argsort(flat, kind="stable")
        start = np.searchsorted(flat[by], np.arange(pivots + 1))
        return cls(n, stored, (by // stored).astype(np.int32), (by % stored).astype(np.int32), start.astype(np.int32))

    def footrule(self, asked: np.ndarray) -> np.ndarray:
        """Footrule of every member to a query with the pivots ``asked``."""
        places = np.arange(len(asked))
        total = np.full(self.n, int(np.abs(self.stored - places).sum()), dtype=np.int32)
        for place, pivot in enumerate(asked):
            file = slice(self.start[pivot], self.start[pivot + 1])
            total[self.member[file]] += np.abs(self.place[file] - place) - abs(self.stored - place)
        return total


def least(values: np.ndarray, count: int) -> np.ndarray:
    """Indexes of the ``count`` smallest values and of all that tie with the last."""
    if count >= len(values):
        return np.arange(len(values))
    return np.flatnonzero(values <= np.partition(values, count - 1)[count - 1])


def search(query: np.ndarray, asked: np.ndarray, files: InvertedFiles, vectors: np.ndarray, first: np.ndarray, candidates: int, keep: int):
    """(index, distance) of the nearest members among the candidates, ties by ``first``."""
    who = least(files.footrule(asked), max(candidates, keep))
    dist = distances(query, vectors[who])
    best = np.lexsort((first[who], dist))[:keep]
    return who[best], dist[best]


def pivots_by_dimension(nodes: DataFrame, count: int, least_count: int) -> dict[int, np.ndarray]:
    """The ``count`` nodes with the lowest hashes, by dimension. Only they reach the driver."""
    some = nodes.select("vec", F.xxhash64("vec").alias("h"), "node").orderBy("h", "node").limit(count).collect()
    found: dict[int, list] = {}
    for r in some:
        found.setdefault(len(r["vec"]), []).append(r["vec"])
    return {d: with_axes(np.array(v, dtype=np.float64), least_count) for d, v in found.items()}


def with_axes(pivots: np.ndarray, least_count: int) -> np.ndarray:
    """Rare dimensions get axes as further pivots."""
    d = pivots.shape[1]
    return pivots if len(pivots) >= least_count else np.concatenate([pivots, np.eye(min(d, least_count), d)])


def nearest_neighbours(vectors: DataFrame, k: int = 10, every: int = 100, pivots: int = 512, stored: int = 128, asked: int = 32, block: int = 8192, candidates: int = 1024, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: for every row whose id is divisible by
    ``every``, the ``k`` nearest other rows found, by Euclidean distance in
    double precision, ties to the smaller id (null ids last). Only rows of the
    query's dimension have a distance to it. Fewer other rows than k: all.

    Vectors that are null, empty, zero or hold null or non-finite components
    take no part. Repeated rows are rows of their own, so a repeated query id
    has one list per row and may find its twin; rows without an id are found
    but ask nothing. An empty table has no rows; other columns are ignored.

    The index is fitted on ``pivots`` vectors (those with the lowest hashes)
    and holds every row. A block of up to ``block`` distinct vectors ranks
    again the ``candidates`` with the smallest footrule, ties included, so
    the share that is ranked exactly (1/8) is the same for any table size."""
    spark = vectors.sparkSession
    scratch = Scratch(spark)
    x = F.col(vector_col)
    wide = x.cast("array<double>")
    fine = x.isNotNull() & F.forall(wide, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists(wide, lambda v: v != 0)
    rows = vectors.where(F.coalesce(fine, F.lit(False))).select(F.col(id_col).cast("long").alias("vec_id"), F.transform(wide, lambda v: v + F.lit(0.0)).alias("vec"))
    rows = scratch.table(rows.withColumn("row", F.monotonically_increasing_id()).withColumn("key", F.xxhash64("vec")))

    # the k + 1 first rows of equal vectors are all that any list can name
    by_id = Window.partitionBy("key", "vec").orderBy(F.asc_nulls_last("vec_id"), "row")
    firsts = rows.withColumn("_i", F.row_number().over(by_id)).where(F.col("_i") <= k + 1)
    nodes = firsts.groupBy("key", "vec").agg(F.array_sort(F.collect_list(F.struct(F.col("vec_id").isNull().alias("no_id"), "vec_id", "row"))).alias("ids"))
    nodes = scratch.table(nodes.withColumn("node", F.monotonically_increasing_id()).withColumn("dim", F.size("vec")))
    bases = pivots_by_dimension(nodes, pivots, asked)
    asking = rows.where(F.col("vec_id") % every == 0)
    queries = scratch.table(asking.join(nodes.select("key", "vec", "node", "dim"), ["key", "vec"]).select("row", "vec_id", "node", "dim", "vec"))

    def basis(d: int) -> np.ndarray:
        got = bases.get(d)
        return with_axes(np.zeros((0, d)), asked) if got is None else got

    # a row per block: its vectors and its inverted files
    sizes = nodes.groupBy("dim").agg(F.ceil(F.count("*") / block).alias("blocks"))
    placed = nodes.join(sizes, "dim").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
    placed = placed.select("dim", "block", "node", F.col("ids")[0]["vec_id"].alias("first"), "vec")

    def posted(table: pa.Table) -> pa.Table:
        table = table.combine_chunks().sort_by("node")
        d = table.column("dim")[0].as_py()
        base = basis(d)
        files = InvertedFiles.of(nearest_pivots(matrix(table.column("vec"), d), base, min(stored, len(base))), len(base))
        first = table.column("first").fill_null((1 << 63) - 1)
        lists = [table.column("vec").combine_chunks().flatten(), table.column("node"), first, *map(pa.array, (files.member, files.place, files.start))]
        values = [pa.array([x.combine_chunks() if isinstance(x, pa.ChunkedArray) else x], pa.list_(x.type)) for x in lists]
        keys = [pa.array([d], pa.int32()), table.column("block").slice(0, 1).combine_chunks()]
        return pa.table(dict(zip(("dim", "block", "vec", "node", "first", "member", "place", "start"), keys + values)))

    placed = placed.repartition(shards_for(spark, 0, 1), "dim", "block")  # a block is work for a task, however small it is
    index = scratch.table(placed.groupBy("dim", "block").applyInArrow(posted, f"dim int, block long, {INDEX}"))

    # a task reads an index block, then streams the queries through it
    asked_nodes = queries.select("node", "dim", "vec").dropDuplicates(["node"])
    ask = asked_nodes.join(sizes, "dim").withColumn("block", F.explode(F.expr("sequence(0L, blocks - 1)")))
    none = [F.lit(None).cast(t).alias(c) for c, t in (x.split(" ") for x in INDEX.split(", ")[2:])]
    ask = ask.select("dim", "block", "vec", F.array("node").alias("node"), *none)
    met = index.withColumn("kind", F.lit(0)).unionByName(ask.withColumn("kind", F.lit(1)))
    met = met.repartition(shards_for(spark, index.count(), 1), "dim", "block").sortWithinPartitions("dim", "block", "kind")

    def searched(batches):
        files = members = mine = firsts = base = None
        for batch in batches:
            q, near, score = [], [], []
            for i in range(batch.num_rows):
                d = batch.column("dim")[i].as_py()
                vec = np.asarray(batch.column("vec")[i].values).reshape(-1, d)
                if batch.column("kind")[i].as_py() == 0:
                    mine, firsts, member, place, start = (np.asarray(batch.column(c)[i].values) for c in ("node", "first", "member", "place", "start"))
                    base = basis(d)
                    files, members = InvertedFiles(len(mine), min(stored, len(base)), member, place, start), vec
                else:
                    at, dist = search(vec[0], nearest_pivots(vec, base, min(asked, len(base)))[0], files, members, firsts, candidates, k + 1)
                    q.append(np.full(len(at), batch.column("node")[i].values[0].as_py()))
                    near.append(mine[at])
                    score.append(dist)
            none = np.empty(0, dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([none, *q]), pa.int64()), pa.array(np.concatenate([none, *near]), pa.int64()), pa.array(np.concatenate([none.astype(np.float64), *score]), pa.float64())],
                ["q", "node", "score"],
            )

    found = scratch.table(met.mapInArrow(searched, "q long, node long, score double"))
    near = found.join(nodes.select("node", "ids"), "node").withColumn("first", F.col("ids")[0])
    best = Window.partitionBy("q").orderBy("score", "first")
    near = near.withColumn("_i", F.row_number().over(best)).where(F.col("_i") <= k + 1)
    lists = near.groupBy("q").agg(F.array_sort(F.flatten(F.collect_list(F.transform("ids", lambda i: F.struct(F.col("score").alias("score"), i["no_id"].alias("no_id"), i["vec_id"].alias("vec_id"), i["row"].alias("row")))))).alias("near"))
    answers = queries.select("row", F.col("vec_id").alias("query_id"), F.col("node").alias("q")).join(lists, "q")
    others = F.slice(F.filter("near", lambda i: i["row"] != F.col("row")), 1, k)
    return answers.select("query_id", F.posexplode(others).alias("at", "x")).select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("x.vec_id").alias("vec_id"), F.col("x.score").alias("score"))
