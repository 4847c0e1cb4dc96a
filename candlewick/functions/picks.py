"""Seeded, exact-size row picks that are independent of partitioning.

``exact_picks`` marks, for each tag, exactly ``k = min(max(minimum,
int(n * fraction)), n - cap_offset)`` rows: those with the smallest
``md5(seed|tag|uid)``, and among rows of one identity those that come first by
the tie columns. It equals ``row_number() OVER (ORDER BY md5(...), ties) <= k``
but never sorts or shuffles the table. The picked rows are those below a cut:

1. ``n`` is counted (one job; metadata-only on a Parquet checkpoint) and the
   hash prefix width is chosen so that there are about sqrt(n) buckets;
2. one scan builds a histogram of the hash prefixes of every tag (about
   sqrt(n) rows per tag, so the prefix-sum window over it stays small);
3. the bucket holding the k-th hash is found from the prefix sums; a second
   scan counts its rows per hash, combined map-side, so an identity that holds
   a third of all rows is one counter. The running sum over these counts
   (about sqrt(n) hashes) gives the k-th hash, how many of its rows are asked
   for, and how many there are.

Where these differ, identities repeat at the cut, and the same two steps go on
inside that identity with the next tie column. One row per tag reaches the
driver, and the cut enters the plan as literals, so the outer query is a plain
projection: no join, no shuffle of the table.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlewick.functions.exprs import row_hash

MAX_BUCKET_HEX = 8
#: Hex digits of a row place that make a bucket (65,536 places each).
PLACE_HEX = 12


class Cut(NamedTuple):
    """``need`` of the ``ties`` rows whose key is ``key`` are picked, and all below."""

    key: str
    need: int
    ties: int


def bucket_hex(n: int) -> int:
    """Hex digits of the hash prefix giving about sqrt(n) buckets."""
    if n <= 1:
        return 1
    return max(1, min(MAX_BUCKET_HEX, math.ceil(math.log(math.sqrt(n), 16))))


def pick_size(n: int, fraction: float, minimum: int, cap_offset: int = 0) -> int:
    """``min(max(minimum, int(n * fraction)), n - cap_offset)``, never negative."""
    return max(0, min(max(minimum, int(n * fraction)), n - cap_offset))


def place_key(place: Column) -> Column:
    """A non-negative long as hex text that sorts like the number."""
    return F.lpad(F.hex(place), 16, "0")


def kth_keys(long: DataFrame, ks: Mapping[str, int], width: int) -> dict[str, Cut]:
    """The cut at the ``ks[tag]``-th smallest key ``h`` of the rows of each
    ``tag`` in ``long`` (keys of equal length, buckets of ``width`` characters)."""
    long = long.withColumn("b", F.substring("h", 1, width))
    k = F.create_map(*[F.lit(x) for item in ks.items() for x in item])[F.col("tag")].cast("bigint")

    def holding(counts: DataFrame, key: str, wanted: Column) -> DataFrame:
        """The row whose rows reach from below the wanted place to it: start < wanted <= end."""
        end = F.sum("_n").over(Window.partitionBy("tag").orderBy(key).rowsBetween(Window.unboundedPreceding, 0))
        placed = counts.withColumn("_k", wanted).withColumn("_end", end).withColumn("_start", F.col("_end") - F.col("_n"))
        return placed.where((F.col("_start") < F.col("_k")) & (F.col("_end") >= F.col("_k")))

    bucket = holding(long.groupBy("tag", "b").agg(F.count(F.lit(1)).alias("_n")), "b", k).select("tag", "b", (F.col("_k") - F.col("_start")).alias("_left"))
    keys = long.join(F.broadcast(bucket), ["tag", "b"]).groupBy("tag", "_left", "h").agg(F.count(F.lit(1)).alias("_n"))
    found = holding(keys, "h", F.col("_left")).select("tag", "h", (F.col("_k") - F.col("_start")).alias("need"), F.col("_n").alias("ties"))
    return {r["tag"]: Cut(r["h"], r["need"], r["ties"]) for r in found.collect()}  # a row per tag


def pick_cuts(df: DataFrame, uid: Column, seed, specs: Mapping[str, tuple[float, int, int]], n: int | None = None) -> dict[str, Cut]:
    """The cut of every tag with a non-empty pick, by identity (two scans for all tags)."""
    if n is None:
        n = df.count()
    ks = {t: k for t, spec in specs.items() if (k := pick_size(n, *spec)) > 0}
    if not ks:
        return {}
    tagged = F.array(*[F.struct(F.lit(t).alias("tag"), row_hash(seed, t, uid).alias("h")) for t in ks])
    return kth_keys(df.select(F.explode(tagged).alias("x")).select("x.tag", "x.h"), ks, bucket_hex(n))


def splits_ties(cuts: Mapping[str, Cut]) -> bool:
    return any(c.need < c.ties for c in cuts.values())


def below(df: DataFrame, hash_: Column, cut: Cut, ties: Sequence[Column]) -> Column:
    """Rows up to ``cut``; a tie at the cut is split by the next of ``ties``."""
    if cut.need == cut.ties:
        return hash_ <= F.lit(cut.key)
    if not ties:
        raise ValueError(f"{cut.ties} rows share an identity of which {cut.need} are to be picked: give columns that tell them apart")
    tied = hash_ == F.lit(cut.key)
    key = ties[0]
    width = PLACE_HEX if len(ties) == 1 else bucket_hex(cut.ties)
    inner = kth_keys(df.where(tied).select(F.lit("tie").alias("tag"), key.alias("h")), {"tie": cut.need}, width)["tie"]
    rest = below(df.where(tied), key, inner, ties[1:])
    return (hash_ < F.lit(cut.key)) | (tied & rest)


def exact_picks(
    df: DataFrame,
    uid: str | Column,
    seed,
    specs: Mapping[str, tuple[float, int, int]],
    prefix: str = "_pick_",
    n: int | None = None,
    cuts: Mapping[str, Cut] | None = None,
    ties: Sequence[Column] = (),
) -> DataFrame:
    """Add one boolean column ``prefix + tag`` per ``specs[tag] = (fraction, minimum, cap_offset)``.

    ``ties``: keys (text of one length) that tell rows of one identity apart,
    the last one unique; without them, an identity that is to be picked in part
    is an error. ``cuts``: those of ``pick_cuts``, where they are known. Runs jobs."""
    uid_col = F.col(uid) if isinstance(uid, str) else uid
    cuts = pick_cuts(df, uid_col, seed, specs, n) if cuts is None else cuts
    picks = {t: below(df, row_hash(seed, t, uid_col), cuts[t], ties) if t in cuts else F.lit(False) for t in specs}
    return df.withColumns({prefix + t: p for t, p in picks.items()})
