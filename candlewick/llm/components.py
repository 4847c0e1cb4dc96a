"""Connected components of a distributed edge list."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.llm.common import Scratch


def connected_components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, root) for every node of ``edges`` (a long, b long, undirected);
    root is the smallest node reachable.

    Alternating large-star and small-star steps: every step is a min-aggregate
    (combined map-side) and an equi-join, so a hub of any degree is summed in
    parts and its join partition can be split; each step is written as a table.
    Ends when a round leaves the edges as they were, after a number of rounds
    that grows with the logarithm of the longest path."""

    def turned(df: DataFrame) -> DataFrame:  # a > b
        return df.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()

    def state(df: DataFrame):
        return tuple(df.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("b", "a") % 1000003)).first())

    now = scratch.table(turned(edges))
    before = None
    while before != (before := state(now)) and before[0]:
        both = now.select("a", "b").union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
        large = scratch.table(turned(both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))))
        scratch.drop(now)
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).union(low.select("a", F.col("low").alias("b")))
        now = scratch.table(turned(small))
        scratch.drop(large)
    roots = now.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)


def spanning(n: int, left, right) -> tuple[np.ndarray, np.ndarray]:
    """Union-find over index pairs: (i, smallest index of its group) for every
    i that isn't the smallest itself."""
    parent = list(range(n))
    for a, b in zip(left, right):
        while parent[a] != a:
            parent[a] = parent[parent[a]]
            a = parent[a]
        while parent[b] != b:
            parent[b] = parent[parent[b]]
            b = parent[b]
        if a != b:
            parent[max(a, b)] = min(a, b)
    top = np.array(parent)
    while True:
        up = top[top]
        if (up == top).all():
            break
        top = up
    moved = np.flatnonzero(top != np.arange(n))
    return moved, top[moved]
