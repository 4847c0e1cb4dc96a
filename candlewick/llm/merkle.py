"""Merkle manifest of a dataset by a nested-struct rollup.

Leaves are ranked inside their group (range partitions, counts per partition)
and the rank is written in digits of the tree's arity. Blocks of ``arity **
levels`` consecutive ranks are dealt out by one shuffle; inside a block the
digit columns are grouped away one after the other, lowest first, and every
grouping nests the child structs of a run, in order, below the digest of the
run. What comes out is one row per block that holds its part of the tree. The
digests of the blocks are the leaves of the next table of blocks, up to one
row per group; the digests of the groups form the last tree in the same way.

Proofs come from the nested structs alone: a transform walks down the tree of
a block, noting the siblings passed, and an explode makes a row of each leaf.
Only the path above a block (one row per block) is handed to it by its key.
No row or task holds more than ``arity ** levels`` leaves of a group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.llm.common import Scratch, shards_for

#: Rows of a range partition when leaves are ranked.
RANK_ROWS = 1_000_000
#: Type of a proof.
PATH = "array<struct<before:string,after:string>>"


def digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def leaf_digest(*values: Column) -> Column:
    """Digest of a row: every value as ``bytes:text``, a null as ``-``."""
    texts = [v.cast("string") for v in values]
    return digest(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]))


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and the siblings of its path lead to."""
    return F.aggregate(proof, leaf, lambda cur, run: digest(F.concat(run["before"], cur, run["after"])))


def proof_text(proof: Column) -> Column:
    """All siblings of a path, level by level and left to right."""
    return F.array_join(F.transform(proof, lambda run: F.concat(run["before"], run["after"])), "")


def ranked(rows: DataFrame, order: list[str], scratch: Scratch) -> tuple[DataFrame, int]:
    """``rows`` (with a group ``g``, not null) with ``n``, the size of the
    group, and ``rank`` in it from 0 by ``order`` (equal rows in any order);
    the number of rows.

    A range partition knows its rows' places; partitions get their offsets
    from counts per (group, partition), so no task sees more than one
    partition, and a row number as last key splits any number of equal rows."""
    spark = rows.sparkSession
    rows = scratch.table(rows)
    count = rows.count()
    parts = shards_for(spark, count, RANK_ROWS)
    keys = ["g", *order, "_tie"]
    sorted_rows = rows.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    placed = scratch.table(sorted_rows.drop("_tie").withColumn("_at", F.monotonically_increasing_id()))
    scratch.drop(rows)
    placed = placed.withColumn("_part", F.shiftright("_at", 33))
    spans = placed.groupBy("g", "_part").agg(F.min("_at").alias("_first"), F.count("*").alias("_rows"))
    before = F.expr("sum(_rows) OVER (PARTITION BY g ORDER BY _part) - _rows")
    spans = spans.select("g", "_part", "_first", before.alias("_before"), F.expr("sum(_rows) OVER (PARTITION BY g)").alias("n"))
    rank = F.col("_at") - F.col("_first") + F.col("_before")
    return placed.join(spans, ["g", "_part"]).select(*rows.columns, "n", rank.alias("rank")), count


def rolled(nodes: DataFrame, arity: int, levels: int) -> DataFrame:
    """``g, n, block, node`` from ``g, n, rank, node``: the digits of the rank
    grouped away, lowest first. A node is a struct of its digest ``hash`` and,
    above the lowest level, its children ``kids``. Levels at which a group has
    one node left pass it on."""
    size = arity**levels
    digits = [F.expr(f"(rank div {arity**k}L) % {arity}").cast("int").alias(f"d{k}") for k in range(levels)]
    rows = nodes.select("g", "n", F.expr(f"rank div {size}L").alias("block"), *digits, "node").repartition("g", "block")
    for k in range(levels):
        keys = ["g", "n", "block", *[f"d{j}" for j in range(k + 1, levels)]]
        rows = rows.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(f"d{k}", "node"))).alias("_run"))
        rows = rows.select(*keys, F.transform("_run", lambda x: x["node"]).alias("kids"))
        joined = digest(F.array_join(F.transform("kids", lambda x: x["hash"]), ""))
        hash_ = F.when(F.col("n") > arity**k, joined).otherwise(F.col("kids")[0]["hash"])
        rows = rows.select(*keys, F.struct(hash_.alias("hash"), F.col("kids")).alias("node"))
    return rows


def leaves_of(node: Column, above: Column, n: Column, arity: int, levels: int) -> Column:
    """Array of (node, proof) of the leaves below ``node``."""
    if not levels:
        return F.array(F.struct(node.alias("node"), above.alias("proof")))
    k = levels - 1
    kids = node["kids"]

    def hashes(start, length):
        return F.array_join(F.transform(F.slice(kids, start, length), lambda x: x["hash"]), "")

    def of(kid, i):
        run = F.struct(hashes(F.lit(1), i).alias("before"), hashes(i + 2, F.lit(arity)).alias("after"))
        passed = F.when(n > arity**k, F.array(run)).otherwise(F.array().cast(PATH))  # named once: an expression, not a variable
        return leaves_of(kid, F.concat(passed, above), n, arity, k)

    return F.flatten(F.transform(kids, of))


def tree(nodes: DataFrame, largest: int, arity: int, levels: int, scratch: Scratch) -> list[tuple[DataFrame, int]]:
    """Tables of blocks (see ``rolled``) and their levels, lowest first, the
    last one with one row per group. ``largest``: no group has more nodes."""
    tables = []
    while True:
        depth = 1
        while depth < levels and arity**depth < largest:
            depth += 1
        size = arity**depth
        tables.append((scratch.table(rolled(nodes, arity, depth)), depth))
        largest = -(-(tables[-1][0].agg(F.max("n")).first()[0] or 0) // size)
        if largest <= 1:
            return tables
        up = F.expr(f"(n + {size - 1}L) div {size}L").alias("n")
        nodes = tables[-1][0].select("g", up, F.col("block").alias("rank"), F.struct(F.col("node.hash").alias("hash"), F.col("block")).alias("node"))


def descended(tables: list[tuple[DataFrame, int]], tops: DataFrame, arity: int) -> DataFrame:
    """``g, node, proof`` and the other columns of ``tops`` for every leaf of
    ``tables``; ``tops`` has a row per group with the path ``above`` it."""
    carried = [c for c in tops.columns if c not in ("g", "above")]
    paths, keys = tops, ["g"]
    for i, (table, depth) in enumerate(reversed(tables)):
        rows = table.join(paths, keys)
        found = rows.select("g", *carried, F.explode(leaves_of(F.col("node"), F.col("above"), F.col("n"), arity, depth)).alias("_leaf"))
        if i == len(tables) - 1:
            return found.select("g", *carried, "_leaf.node", "_leaf.proof")
        paths = found.select("g", *carried, F.col("_leaf.node.block").alias("block"), F.col("_leaf.proof").alias("above"))
        keys = ["g", "block"]


def merkle_manifest(docs: DataFrame, columns: tuple[str, ...], id_col: str = "doc_id", group_col: str = "lang", arity: int = 2, levels: int = 10, carry: dict[str, Column] | None = None) -> DataFrame:
    """A row per row of ``docs``: its id, ``leaf``, ``subroot`` (of its group),
    ``root`` (of all) and ``proof``, the siblings on its path to the root
    (``array<struct<before, after>>``, lowest level first, digests as text;
    a run of one has none), with the columns of ``carry`` computed on the way.

    Digests are lowercase hex SHA-256. A leaf hashes the values of ``columns``
    in the order given (null: ``-``, else UTF-8 bytes, ``:`` and the text). In
    a group leaves ascend by id (null first, then by digest, so repeated ids
    have a defined tree and equal rows are interchangeable); while more than
    one node remains, every ``arity`` consecutive ones become the digest of
    their joined text. A lone leaf is its group's subroot. Subroots, by group
    (null first, then by bytes), are joined to the root in the same way. Empty
    texts have the value ``0:``. An empty table has no rows. Very long texts
    are hashed whole where they lie and never moved. Other columns of ``docs``,
    whatever their names, take no part.

    ``arity ** levels`` leaves are the most that a row of the tree holds."""
    if arity < 2 or levels < 1:
        raise ValueError("arity must be 2 or more and levels 1 or more")
    scratch = Scratch(docs.sparkSession)
    group = F.coalesce(F.concat(F.lit("1"), F.col(group_col).cast("string")), F.lit("0"))
    extra = F.struct(*[v.alias(k) for k, v in carry.items()]) if carry else F.lit(None).cast("struct<_:int>")
    leaves = docs.select(group.alias("g"), F.col(id_col).cast("long").alias("id"), leaf_digest(*[F.col(c) for c in columns]).alias("hash"), extra.alias("more"))
    leaves, count = ranked(leaves, ["id", "hash"], scratch)
    tables = tree(leaves.select("g", "n", "rank", F.struct("hash", "id", "more").alias("node")), count, arity, levels, scratch)

    groups = tables[-1][0].select(F.lit("").alias("g"), F.col("g").alias("name"), F.col("node.hash").alias("hash"))
    groups, count = ranked(groups, ["name"], scratch)
    above = tree(groups.select("g", "n", "rank", F.struct("hash", "name").alias("node")), count, arity, levels, scratch)
    top = above[-1][0].select("g", F.col("node.hash").alias("root"), F.array().cast(PATH).alias("above"))
    subroots = descended(above, top, arity).select(F.col("node.name").alias("g"), "root", F.col("node.hash").alias("subroot"), F.col("proof").alias("above"))
    found = descended(tables, subroots, arity)
    carried = [F.col(f"node.more.{k}").alias(k) for k in carry or ()]
    return found.select(F.col("node.id").alias(id_col), F.col("node.hash").alias("leaf"), "subroot", "root", "proof", *carried)


def tampered_check(docs: DataFrame, columns: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"), changed: str = "n_chars", modulus: int = 7, **options) -> DataFrame:
    """The manifest with every proof folded from the leaf that a changed copy
    of the data has: where ``modulus`` divides the CRC32 of the decimal id
    (rows without an id stay as they are), ``changed`` is one more (null stays
    null). ``proof_sha256`` is the digest of a path's siblings; ``verified``
    tells whether the folded root is the root. Rows: see ``merkle_manifest``."""
    id_col = options.get("id_col", "doc_id")
    hit = F.coalesce(F.crc32(F.col(id_col).cast("long").cast("string").cast("binary")) % modulus == 0, F.lit(False))
    more = (F.col(changed).cast("decimal(20,0)") + 1).cast("string")
    other = leaf_digest(*[more if c == changed else F.col(c) for c in columns])
    rows = merkle_manifest(docs, columns, carry={"other": F.when(hit & F.col(changed).isNotNull(), other)}, **options)
    root = folded(F.coalesce("other", "leaf"), F.col("proof"))
    out = rows.select(id_col, "leaf", "subroot", "root", digest(proof_text(F.col("proof"))).alias("proof_sha256"), root.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
