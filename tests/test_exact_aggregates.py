"""Sums, averages and deviations have the same bits under any partitioning."""

import math
import random
from fractions import Fraction

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from candlewick.functions.exact import exact_avg, exact_stddev, exact_sum
from candlewick.operators import analytics as A
from tests.test_properties import SETTINGS


def measures(df):
    return df.groupBy("k").agg(exact_sum("x").alias("s"), exact_avg("x").alias("a"), exact_stddev("x").alias("d"))


def bits(rows):
    return sorted((r["k"], *[None if v is None else float(v).hex() for v in (r["s"], r["a"], r["d"])]) for r in rows)


def test_same_bits_under_any_partitioning(spark):
    rnd = random.Random(1)
    rows = [(rnd.choice("ab"), rnd.uniform(-1, 1) * 10 ** rnd.randint(-12, 9)) for _ in range(3000)]
    df = spark.createDataFrame(rows, "k string, x double")
    want = bits(measures(df.repartition(1)).collect())
    for parts in (2, 13):
        assert bits(measures(df.repartition(parts)).collect()) == want
    plain = {tuple(v.hex() for v in df.repartition(p).where("k = 'a'").agg(F.sum("x"), F.avg("x")).first()) for p in (1, 2, 13)}
    assert len(plain) > 1  # what Spark's own sums do with these rows


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.floats(-1e9, 1e9), st.sampled_from([0.1, 1e-9, -0.0, 123.456])), max_size=40))
def test_values_are_right(spark, values):
    df = spark.createDataFrame([("k", v) for v in values], "k string, x double").repartition(3)
    got = df.agg(exact_sum("x").alias("s"), exact_avg("x").alias("a"), exact_stddev("x").alias("d")).first()
    some = [v for v in values if v is not None]
    if not some:
        assert tuple(got) == (None, None, None)
        return
    total = sum(map(Fraction, some))
    assert got["s"] == pytest.approx(float(total), rel=1e-15, abs=1e-15)
    assert got["a"] == pytest.approx(float(total / len(some)), rel=1e-14, abs=1e-15)
    if len(some) == 1:
        assert got["d"] is None
    else:
        mean = total / len(some)
        want = math.sqrt(float(sum((Fraction(v) - mean) ** 2 for v in some) / (len(some) - 1)))
        top = max(map(abs, some))
        assert got["d"] == pytest.approx(want, rel=1e-9, abs=1e-7 * top + 1e-12)


def test_values_beyond_the_integers_fall_back(spark):
    nan, inf = float("nan"), float("inf")
    rows = [("big", 1e300), ("big", 1.0), ("nan", nan), ("nan", 1.0), ("inf", inf), ("inf", 2.0), ("one", 0.1), ("same", 0.1), ("same", 0.1), ("none", None)]
    got = {r["k"]: r for r in measures(spark.createDataFrame(rows, "k string, x double")).collect()}
    assert got["big"]["s"] == 1e300 and math.isnan(got["nan"]["a"]) and got["inf"]["s"] == inf
    assert got["one"]["s"] == 0.1 and got["one"]["d"] is None and got["same"]["d"] == 0.0 and got["none"]["a"] is None


def test_ranks_of_near_ties_do_not_move(spark):
    """Two symbols with the same values in another order tie exactly."""
    rnd = random.Random(2)
    values = [rnd.uniform(0, 1000) for _ in range(500)]
    rows = [(s, 0.0, v, 0.0, 0.0) for s in ("Z", "A") for v in sorted(values, key=lambda _: rnd.random())]
    df = spark.createDataFrame(rows, "symbol string, open double, high double, low double, close double")
    seen = set()
    for parts in (1, 13):
        found = A.volatility_ranking(df.repartition(parts)).orderBy("rank").collect()
        assert [r["symbol"] for r in found] == ["A", "Z"]
        seen |= {(r["avg_price_range"].hex(), r["stddev_price_range"].hex()) for r in found}
    assert len(seen) == 1
