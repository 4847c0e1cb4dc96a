"""Trailing-window request counts (the rate limiter's sliding log as a query).

``trailing_count`` gives every row the number of rows with the same key in
the last ``window_us`` microseconds, its own time included, and flags
counts above ``limit``. A plain ``RANGE`` window partitioned by key would put
a hot key (or the whole table, without a key) into one task. Instead the rows
are swept in the order of key and time by tasks that each hold one range:

* a bounded sample gives range bounds; a row finds its range by bisection of
  the bounds, a plain expression, so one shuffle by range number and one sort
  bring all neighbours together, for keys of any size;
* inside a range, a range frame counts what is there. What earlier ranges of
  the same key still have in the window at a range's start is one number per
  range, counted beforehand from keys and times alone; it is taken down by
  bare marks, which only those rows send whose window ends in a later range;
* an instant of one key that fills a range by itself cannot be cut by time.
  Its rows stay where they are: one mark with their number takes part in the
  sweep, and its count is handed to them by a join with at most one row per
  range.

A table that fits one range needs neither sample nor marks."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlewick.functions.exprs import bisect_count, constant_array, ntz_epoch_micros
from candlewick.schema import RATE_LIMIT, RATE_WINDOW_SECONDS
from candlewick.session import MAX_SHUFFLE_PARTITIONS, cut_lineage

#: Rows of a range.
RANGE_ROWS = 1_000_000
#: Sampled rows per range.
SAMPLE = 32
_POINT = "struct<a:bigint,b:bigint,t:bigint>"


class Ranges(NamedTuple):
    """Range bounds (key hashes and time, ascending), those that are crowded
    instants, and per range how many rows of earlier ranges its start still sees."""

    bounds: list[tuple[int, int, int]]
    crowded: list[bool]
    carried: list[int]


def _micros(df: DataFrame, ts: str) -> Column:
    """Epoch microseconds of the time column, zone independent."""
    if dict(df.dtypes)[ts] == "timestamp_ntz":
        return ntz_epoch_micros(F.col(ts))
    return F.unix_micros(F.col(ts).cast("timestamp"))


def _bounds(bounds: list[tuple[int, int, int]]) -> Column:
    return constant_array([dict(zip("abt", b)) for b in bounds], _POINT)


def _point(time: Column) -> Column:
    return F.struct(F.col("_a").alias("a"), F.col("_b").alias("b"), time.alias("t"))


def range_of(point: Column, bounds: list[tuple[int, int, int]]) -> Column:
    """How many of the ascending ``bounds`` are at or below ``point``, by bisection."""
    return bisect_count(_bounds(bounds), len(bounds), point)


def find_ranges(base: DataFrame, rows: int, window_us: int, range_rows: int) -> Ranges:
    """Bounds from a sample of at most ``SAMPLE`` rows per range (about 1.5
    times that where the sampler is unlucky), then one pass over keys and
    times for what is carried into each range. Both come to the driver: a few
    numbers per range."""
    parts = min(MAX_SHUFFLE_PARTITIONS, -(-rows // range_rows))
    if parts < 2:
        return Ranges([], [], [0])
    share = min(1.0, SAMPLE * parts / rows)
    points = base.select("_a", "_b", "_at")
    some = sorted(tuple(r) for r in points.sample(share, seed=1).limit(2 * SAMPLE * parts).collect())
    cuts = [some[len(some) * i // parts] for i in range(1, parts)] if some else []
    bounds = sorted(set(cuts))
    crowded = [cuts.count(b) > 1 for b in bounds] if len(bounds) < len(cuts) else [False] * len(bounds)
    ends = points.select(range_of(_point(F.col("_at")), bounds).alias("i"), range_of(_point(F.col("_at") + window_us), bounds).alias("j"))
    steps = [0] * (len(bounds) + 2)
    for r in ends.where("j > i").groupBy("i", "j").count().collect():  # ranges that a window reaches
        steps[r["i"] + 1] += r["count"]
        steps[r["j"] + 1] -= r["count"]
    carried, now = [], 0
    for step in steps[: len(bounds) + 1]:
        now += step
        carried.append(now)
    return Ranges(bounds, crowded, carried)


def trailing_count(
    df: DataFrame,
    ts: str,
    keys: Sequence[str] = (),
    window_us: int = RATE_WINDOW_SECONDS * 1_000_000,
    limit: int = RATE_LIMIT,
    out: str = "trailing_count",
    range_rows: int = RANGE_ROWS,
) -> DataFrame:
    """``df`` with ``out`` and ``over_limit``. Null keys form a group; rows
    without a time bypass the sweep and get nulls. The input is read once and
    written to the shared folder (``cut_lineage``); runs jobs."""
    keys = list(keys)
    hashed = [F.xxhash64(F.lit(i), *[F.col(k) for k in keys]) for i in (0, 1)]
    base = cut_lineage(df.withColumns({"_at": _micros(df, ts), "_a": hashed[0], "_b": hashed[1]}))
    total, rows = base.agg(F.count(F.lit(1)), F.count("_at")).first()
    timed = base.where("_at is not null") if rows < total else base
    ranges = find_ranges(timed, rows, window_us, range_rows)
    swept, crowded = _sweep(timed, keys, window_us, ranges)
    count = F.coalesce(F.sum("_own").over(_frame(keys, 1 - window_us, 0)), F.lit(0))
    if ranges.bounds:
        starts = F.get(_bounds(ranges.bounds), F.col("_range") - 1)  # null for the first range
        same_key = (starts["a"] == F.col("_a")) & (starts["b"] == F.col("_b"))
        carried = F.get(constant_array(ranges.carried, "bigint"), F.col("_range"))
        gone = F.coalesce(F.sum("_gone").over(_frame(keys, Window.unboundedPreceding, 0)), F.lit(0))
        count = count + F.when(F.coalesce(same_key, F.lit(False)), carried - gone).otherwise(F.lit(0))
    swept = swept.withColumn(out, count)
    result = swept.where("_kind = 0").select(*df.columns, out) if ranges.bounds else swept.select(*df.columns, out)
    if crowded is not None:
        told = F.broadcast(swept.where("_kind = 2").select("_a", "_b", "_at", out))  # at most a row per bound
        result = result.unionByName(crowded.join(told, ["_a", "_b", "_at"]).select(*df.columns, out))
    if rows < total:
        result = result.unionByName(base.where("_at is null").select(*df.columns, F.lit(None).cast("long").alias(out)))
    return result.withColumn("over_limit", F.col(out) > F.lit(limit))


def _frame(keys: list[str], start: int, end: int):
    return Window.partitionBy("_range", *keys).orderBy("_at").rangeBetween(start, end)


def _sweep(timed: DataFrame, keys: list[str], window_us: int, ranges: Ranges) -> tuple[DataFrame, DataFrame | None]:
    """Rows (``_kind`` 0) and marks (1: the end of a window, 2: a crowded
    instant) by range, and the rows of crowded instants, which are not moved."""
    if not ranges.bounds:
        return timed.withColumns({"_range": F.lit(0), "_own": F.lit(1).cast("long")}), None
    rows = timed.withColumn("_range", range_of(_point(F.col("_at")), ranges.bounds)).withColumn("_until", range_of(_point(F.col("_at") + window_us), ranges.bounds))
    crowded = marks = None
    if any(ranges.crowded):
        last = F.col("_range") - 1
        here = F.get(constant_array(ranges.crowded, "boolean"), last) & (F.get(_bounds(ranges.bounds), last) == _point(F.col("_at")))
        rows = rows.withColumn("_here", F.coalesce(here, F.lit(False)))
        crowded, rows = rows.where("_here"), rows.where("NOT _here").drop("_here")
        marks = crowded.groupBy(*keys, "_a", "_b", "_at", "_range", "_until").agg(F.count(F.lit(1)).alias("_n"))
    moved = [c for c in timed.columns if c not in (*keys, "_a", "_b", "_at")]

    def dealt(df: DataFrame, kind: int, number: Column) -> DataFrame:
        """Each row of ``df`` once in its own range and, where its window ends in a later one, as a mark there."""
        own = F.struct(F.lit(kind).alias("_kind"), F.col("_at"), F.col("_range"), number.alias("_own"), F.lit(0).cast("long").alias("_gone"))
        end = F.struct(F.lit(1).alias("_kind"), (F.col("_at") + window_us).alias("_at"), F.col("_until").alias("_range"), F.lit(0).cast("long").alias("_own"), number.alias("_gone"))
        both = F.when(F.col("_until") > F.col("_range"), F.array(own, end)).otherwise(F.array(own))
        out = df.withColumn("_x", F.explode(both)).drop("_at", "_range", "_until").select("*", "_x.*").drop("_x")
        held = [F.when(F.col("_kind") == kind, F.col(c)).alias(c) for c in moved] if kind == 0 else [F.lit(None).cast(timed.schema[c].dataType).alias(c) for c in moved]
        return out.select(*keys, *held, "_a", "_b", "_at", "_kind", "_range", "_own", "_gone")

    out = dealt(rows, 0, F.lit(1).cast("long"))
    if marks is not None:
        out = out.unionByName(dealt(marks, 2, F.col("_n")))
    return out.repartition(len(ranges.bounds) + 1, "_range"), crowded
