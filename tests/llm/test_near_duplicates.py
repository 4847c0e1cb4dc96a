import math
import random

import numpy as np
import pytest
import xxhash

from candlewick.llm.common import Scratch
from candlewick.llm.components import connected_components, spanning
from candlewick.llm.embed_dedup import embedding_components
from candlewick.llm.simhash import close_pairs, covering_masks, keep_one, simhash_components


def grouped(n, pairs):
    top = list(range(n))

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    for a, b in pairs:
        a, b = find(a), find(b)
        top[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def test_components_of_paths_stars_and_islands(spark):
    rnd = random.Random(3)
    edges = [(i, i + 1) for i in range(60)] + [(1000, i) for i in range(1001, 1300)] + [(5000 + rnd.randrange(80), 5000 + rnd.randrange(80)) for _ in range(60)]
    nodes = sorted({x for e in edges for x in e if e[0] != e[1]})
    at = {x: i for i, x in enumerate(nodes)}
    want = grouped(len(nodes), [(at[a], at[b]) for a, b in edges if a != b])
    got = connected_components(spark.createDataFrame(edges, "a long, b long"), Scratch(spark)).collect()
    assert {r["node"]: r["root"] for r in got} == {x: nodes[want[at[x]]] for x in nodes}
    assert connected_components(spark.createDataFrame([], "a long, b long"), Scratch(spark)).count() == 0


def test_spanning():
    moved, top = spanning(6, [5, 1, 4], [4, 0, 2])
    assert dict(zip(moved.tolist(), top.tolist())) == {1: 0, 4: 2, 5: 2}


def test_masks_cover_every_triple():
    masks = covering_masks(3)
    assert len(masks) == 15
    for a in range(64):
        for b in range(a):
            for c in range(b):
                bits = 1 << a | 1 << b | 1 << c
                assert any(not m & bits for m in masks)


def test_crowded_bucket_connects_like_all_pairs():
    rnd = np.random.default_rng(0)
    base = rnd.integers(0, 1 << 62, 40, dtype=np.uint64)
    fps = np.unique(np.concatenate([b ^ (np.uint64(1) << rnd.integers(0, 64, 60, dtype=np.uint64)) ^ (np.uint64(1) << rnd.integers(0, 64, 60, dtype=np.uint64)) for b in base]))
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 3
    want = grouped(len(fps), zip(*np.nonzero(np.triu(near, 1))))
    a, b = close_pairs(fps, 3, 0)
    assert all(near[i, j] for i, j in zip(a, b) if len(fps) <= 512)
    assert grouped(len(fps), zip(a, b)) == want


def brute_fp(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
    sh = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    out = 0
    for bit in range(64):
        if sum(xxhash.xxh64_intdigest(s, 42) >> bit & 1 for s in sh) * 2 > len(sh):
            out |= 1 << bit
    return out


def simhash_rows():
    rnd = random.Random(11)
    words = ["the", "Of", "ÉÀ", "river", "stone", "x1", "中文", "and", "blue"] + [f"w{i}" for i in range(200)]
    rows = []
    for i in range(150):
        text = [rnd.choice(words) for _ in range(rnd.choice([1, 2, 3, 5, 40, 120]))]
        rows.append((i * 3, " ".join(text), "c"))
        for k in range(rnd.choice([0, 0, 1, 3])):
            near = list(text)
            near[rnd.randrange(len(near))] = rnd.choice(words)
            rows.append((1000 + i * 10 + k, rnd.choice([" ", "\n", " \t "]).join(near), "d"))
    same = " ".join(rnd.choice(words) for _ in range(60))
    rows += [(4000 + i, same, None) for i in range(120)]
    return rows + [(7000, None, "n"), (7001, "", "n"), (7002, " \n ", "n"), (None, same, "z"), (None, None, "z"), (4001, same, None), (8000, "long " * 40000, "")]


def test_simhash_equals_brute_force(frame):
    rows = simhash_rows()
    fps = [brute_fp(t) for _, t, _ in rows]
    pairs = [(i, j) for i in range(len(rows)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 3]
    group = grouped(len(rows), pairs)
    low = {}
    for (i, _, _), g in zip(rows, group):
        if i is not None:
            low[g] = min(low.get(g, i), i)
    want = sorted(((i, f"{fp:016x}", low.get(g)) for (i, _, _), fp, g in zip(rows, fps, group)), key=str)
    df = frame("doc_id long, text string, component_id string", rows, 4)
    got = sorted(map(tuple, simhash_components(df).collect()), key=str)
    assert got == want
    kept = keep_one(df).collect()
    assert len(kept) == len(set(group)) and kept[0].__fields__ == df.columns
    assert sorted(r["doc_id"] for r in kept) == sorted(low.values())
    assert simhash_components(frame("doc_id long, text string", [])).count() == 0


def brute_embeddings(rows, t):
    ok = []
    for _, v, lab in rows:
        good = lab is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(x != 0 for x in v)
        ok.append(np.array(v, np.float64) if good else None)
    pairs = []
    for i in range(len(rows)):
        for j in range(i):
            if ok[i] is not None and ok[j] is not None and rows[i][2] == rows[j][2] and len(ok[i]) == len(ok[j]):
                if ok[i] @ ok[j] / (np.linalg.norm(ok[i]) * np.linalg.norm(ok[j])) >= t:
                    pairs.append((i, j))
    return pairs


@pytest.mark.parametrize("block,pivots", [(4096, None), (40, 8), (16, 30)])
def test_embeddings_equal_brute_force(spark, block, pivots):
    rnd = np.random.default_rng(block)
    rows, n = [], 0
    for c in range(60):
        base = rnd.normal(size=8)
        for _ in range(int(rnd.integers(1, 9))):
            rows.append((n, [float(x) for x in np.float32(base + rnd.normal(size=8) * rnd.choice([0.0, 0.02, 0.15]))], int(c % 2)))
            n += 1
    hot = [float(x) for x in np.float32(rnd.normal(size=8))]
    rows += [(n + i, hot, 1) for i in range(70)]
    rows += [(n + 100 + i, [float(np.float32(x + 0.001 * rnd.normal())) for x in hot], 1) for i in range(70)]
    rows += [(n + 200, None, 1), (n + 201, [0.0] * 8, 1), (n + 202, [float("nan")] * 8, 1), (n + 203, [None] + hot[1:], 1), (n + 204, hot, None), (n + 205, [float("inf")] * 8, 0), (n + 206, [], 0), (n + 207, hot[:4], 1), (None, hot, 1), (n + 3, hot, 1), (n + 208, [2 * x for x in hot], 1)]
    pairs = brute_embeddings(rows, 0.98)
    links = [0] * len(rows)
    for a, b in pairs:
        links[a] += 1
        links[b] += 1
    group = grouped(len(rows), pairs)
    low = {}
    for (i, _, _), g in zip(rows, group):
        if i is not None:
            low[g] = min(low.get(g, i), i)
    want = sorted(((i, k, low.get(g), i == low.get(g)) for (i, _, _), k, g in zip(rows, links, group)), key=str)
    df = spark.createDataFrame([(*r, "clash") for r in rows], "vec_id long, embedding array<float>, label int, vec string").repartition(5)
    got = sorted(map(tuple, embedding_components(df, block=block, pivots=pivots).collect()), key=str)
    assert got == want
    assert embedding_components(df.limit(0)).count() == 0
