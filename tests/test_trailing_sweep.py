"""The trailing count over many ranges, held against its definition."""

import datetime as dt
import random

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from candlewick.operators.windows import find_ranges, range_of, trailing_count
from tests.test_properties import SETTINGS

START = dt.datetime(2024, 1, 1)


def frame(spark, rows, parts=3):
    """rows: (id, key, microseconds or None)."""
    made = [(i, k, None if t is None else START + dt.timedelta(microseconds=t), "payload") for i, k, t in rows]
    return spark.createDataFrame(made, "id long, k string, ts timestamp_ntz, note string").repartition(parts)


def defined(rows, window):
    out = {}
    for i, k, t in rows:
        out[i] = None if t is None else sum(1 for _, k2, t2 in rows if k2 == k and t2 is not None and t - window < t2 <= t)
    return out


def check(spark, rows, window, keys=("k",), **options):
    got = trailing_count(frame(spark, rows), "ts", list(keys), window_us=window, limit=3, **options)
    assert got.columns == ["id", "k", "ts", "note", "trailing_count", "over_limit"]
    want = defined(rows if keys else [(i, "", t) for i, _, t in rows], window)
    found = {r["id"]: r for r in got.collect()}
    assert {i: r["trailing_count"] for i, r in found.items()} == want
    assert all(r["note"] == "payload" and r["over_limit"] == (None if want[i] is None else want[i] > 3) for i, r in found.items())
    assert {i: r["k"] for i, r in found.items()} == {i: k for i, k, _ in rows}


@pytest.mark.parametrize("window", [1, 50, 1000, 100_000])
def test_windows_over_several_ranges(spark, window):
    rnd = random.Random(window)
    rows = [(i, rnd.choice(["a", "a", "a", "b", None]), rnd.randint(0, 2000)) for i in range(300)] + [(300, "a", None), (301, None, None)]
    check(spark, rows, window, range_rows=20)
    check(spark, rows, window, keys=(), range_rows=20)


def test_all_rows_at_one_instant_over_several_tasks(spark):
    rows = [(i, "a", 7) for i in range(400)]
    check(spark, rows, 60, range_rows=40)
    df = frame(spark, rows, parts=8)
    assert trailing_count(df, "ts", ["k"], window_us=60, range_rows=40).groupBy(F.spark_partition_id()).count().count() > 1


def test_crowded_instants_among_others(spark):
    rnd = random.Random(4)
    rows = [(i, "hot", rnd.choice([100, 100, 150, rnd.randint(0, 300)])) for i in range(300)]
    rows += [(300 + i, rnd.choice("abc"), rnd.randint(0, 300)) for i in range(100)]
    for window in (50, 51, 1000):
        check(spark, rows, window, range_rows=25)


def test_crowded_instant_is_not_moved(spark):
    rows = [(i, "hot", 5) for i in range(500)] + [(500 + i, "x", i) for i in range(100)]
    df = frame(spark, rows).withColumn("_at", F.unix_micros(F.col("ts").cast("timestamp"))).withColumns({"_a": F.xxhash64(F.lit(0), "k"), "_b": F.xxhash64(F.lit(1), "k")})
    ranges = find_ranges(df, 600, 10, 60)
    assert any(ranges.crowded) and len(ranges.carried) == len(ranges.bounds) + 1


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.integers(0, 40)), min_size=1, max_size=50), st.integers(1, 50), st.integers(3, 20))
def test_any_table_any_ranges(spark, rows, window, range_rows):
    check(spark, [(i, k, t) for i, (k, t) in enumerate(rows)], window, range_rows=range_rows)


def test_bisection_counts_the_bounds_below(spark):
    bounds = [(0, 0, i * 10) for i in range(1, 8)]
    point = F.struct(F.lit(0).cast("long").alias("a"), F.lit(0).cast("long").alias("b"), F.col("id").alias("t"))
    got = [r[0] for r in spark.range(0, 100).orderBy("id").select(range_of(point, bounds)).collect()]
    assert got == [sum(b[2] <= t for b in bounds) for t in range(100)]
