"""Sums, averages and deviations of doubles that don't depend on the order of
the rows.

A double is cut into four integers of 30 bits (the highest may be larger) with
its sign, whose sums are exact in any order; what is below 2^-60 is left off,
in the same way for every row. The sums are put together once per group, so
results have the same bits for any partitioning, and ranks of near ties don't
change between runs. Integers stay in hash aggregates and generated code.

Groups with a value of 2^83 (about 1e25) or more, with NaN or infinity, or
whose integer sums leave 64 bits (not before 8e9 rows, for values below 1e13)
fall back to Spark's own aggregate of doubles; for deviations these limits hold
for the squares."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LIMB = float(1 << 30)
BELOW = float(1 << 83)


def _x(x) -> Column:
    return (F.col(x) if isinstance(x, str) else x).cast("double")


def _limbs(x: Column) -> tuple[Column, ...]:
    """``x`` as integers: units of 2^30, 1, 2^-30 and 2^-60."""
    size = F.when(F.abs(x) < F.lit(BELOW), F.abs(x))
    sign = F.when(x < 0, F.lit(-1)).otherwise(F.lit(1)).cast("bigint")
    top = F.floor(size / F.lit(LIMB))
    below = size - top * F.lit(LIMB)  # exact, as are the next ones
    first = (below - F.floor(below)) * F.lit(LIMB)
    second = (first - F.floor(first)) * F.lit(LIMB)
    return tuple(limb * sign for limb in (top, F.floor(below), F.floor(first), F.floor(second)))


def _exact(x: Column) -> Column:
    """The sum, or null where it can't be exact."""
    limbs = _limbs(x)
    top, whole, first, second = (F.try_sum(limb).cast("double") for limb in limbs)
    return F.when(F.count(x) == F.count(limbs[0]), top * F.lit(LIMB) + (whole + (first + second / F.lit(LIMB)) / F.lit(LIMB)))


def exact_sum(x) -> Column:
    x = _x(x)
    return F.coalesce(_exact(x), F.sum(x))


def exact_avg(x) -> Column:
    x = _x(x)
    return F.coalesce(_exact(x) / F.nullif(F.count(x), F.lit(0)), F.avg(x))


def exact_stddev(x) -> Column:
    """Sample standard deviation; null for fewer than two values, as ``stddev_samp`` gives."""
    x = _x(x)
    n = F.count(x)
    spread = _exact(x * x) - _exact(x) * _exact(x) / F.nullif(n, F.lit(0))
    several = F.sqrt(F.when(spread < 0, F.lit(0.0)).otherwise(spread) / F.nullif(n - 1, F.lit(0)))
    exact = F.when(F.min(x) == F.max(x), F.when(n > 1, F.lit(0.0))).otherwise(several)
    return F.coalesce(exact, F.stddev_samp(x))
