import numpy as np
import pytest
from pyspark.sql import functions as F

from candlewick.llm.permutation import InvertedFiles, nearest_neighbours, nearest_pivots
from candlewick.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<double>, score string, node int"


def brute(rows, k, every):
    """All neighbours of every query row, by exact distance."""
    good = []
    for n, (i, v) in enumerate(rows):
        if v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            good.append((n, i, np.array(v, dtype=np.float64)))
    out = []
    for n, i, q in good:
        if i is None or i % every:
            continue
        near = sorted((float(np.sqrt(((q - v) ** 2).sum())), j is None, j or 0) for m, j, v in good if m != n and len(v) == len(q))
        out += [(i, r + 1, None if none else j, d) for r, (d, none, j) in enumerate(near[:k])]
    return out


def rounded(rows):
    return sorted([(q, r, v, round(s, 9)) for q, r, v, s in rows], key=repr)


def test_odd_rows_against_brute_force(frame):
    """With few vectors every block ranks all its members exactly."""
    nan, inf = float("nan"), float("inf")
    rows = [(i, [float((i * 7) % 5), float((i * 3) % 4), 1.0]) for i in range(60)]
    rows += [(100, [1.0, 1.0, 1.0])] * 3 + [(None, [1.0, 1.0, 1.0]), (300, None), (400, []), (500, [0.0, 0.0, 0.0]), (600, [nan, 1.0, 0.0]), (700, [inf, 1.0, 0.0]), (800, [None, 1.0, 2.0])]
    rows += [(900, [1.0, 2.0]), (901, [1.0, 2.5]), (1000, [4.0]), (1100, [-0.0, 5.0, 1.0]), (1101, [0.0, 5.0, 1.0])]
    df = frame(SCHEMA, [(i, v, "clash", 1) for i, v in rows])
    got = nearest_neighbours(df, k=4, every=20, pivots=8, stored=4, asked=3, block=8, candidates=64)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert rounded(map(tuple, got.collect())) == rounded(brute(rows, 4, 20))


def test_large_group_of_copies(frame):
    rows = [(i, [1.0, 0.0]) for i in range(400)] + [(i, [1.0, i / 1000]) for i in range(400, 420)]
    got = nearest_neighbours(frame(SCHEMA, [(i, v, None, 0) for i, v in rows]), k=3, every=100, block=8)
    assert rounded(map(tuple, got.collect())) == rounded(brute(rows, 3, 100))


def test_extreme_lengths(frame):
    rows = [(0, [1e200, 0.0]), (1, [0.0, 1e200]), (2, [1e-200, 0.0]), (3, [2e-200, 0.0])]
    got = {(q, v): s for q, _, v, s in nearest_neighbours(frame(SCHEMA, [(i, v, None, 0) for i, v in rows]), every=1).collect()}
    assert got[0, 1] == pytest.approx(2**0.5 * 1e200) and got[2, 3] == pytest.approx(1e-200)


def test_empty_table(frame):
    assert nearest_neighbours(frame(SCHEMA, [])).count() == 0


def test_footrule_equals_its_definition():
    rnd = np.random.default_rng(3)
    pivots, vectors = rnd.normal(size=(20, 6)), rnd.normal(size=(50, 6))
    orders = nearest_pivots(vectors, pivots, 7)
    far = np.linalg.norm(vectors[:, None] - pivots[None], axis=2)
    assert (orders == np.argsort(far, axis=1)[:, :7]).all()
    asked = nearest_pivots(rnd.normal(size=(1, 6)), pivots, 5)[0]
    want = [sum(abs((list(o).index(p) if p in o else 7) - at) for at, p in enumerate(asked)) for o in orders]
    assert InvertedFiles.of(orders, 20).footrule(asked).tolist() == want


def test_recall_on_random_directions(spark):
    """Vectors without any structure, in several blocks, default settings."""
    rnd = np.random.default_rng(11)
    v = rnd.normal(size=(12_000, 64))
    v /= np.linalg.norm(v, axis=1)[:, None]
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<double>").repartition(4)
    got = nearest_neighbours(df).toPandas()
    assert len(got) == 120 * 10 and sorted(got["rank"].unique()) == list(range(1, 11))
    hits = 0
    for q, own in got.groupby("query_id"):
        dist = np.sqrt(((v - v[q]) ** 2).sum(axis=1))
        dist[q] = np.inf
        hits += len(set(np.argsort(dist, kind="stable")[:10]) & set(own["vec_id"]))
        assert np.allclose(own.sort_values("rank")["score"], dist[own.sort_values("rank")["vec_id"]], rtol=1e-12)
    assert hits / 1200 >= 0.93


def test_query_on_the_given_table(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r[0], list(r[1])) for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", F.col("embedding").cast("array<double>")).collect()]
    got = {(q, v) for q, _, v, _ in QUERIES["op13_approximate_neighbours"](spark, sf).collect()}
    want = {(q, v) for q, _, v, _ in brute(rows, 10, 100)}
    assert len(got) == len(want) and len(got & want) >= 0.9 * len(want)
