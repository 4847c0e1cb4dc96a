"""Property tests: operators against brute-force definitions on small random tables."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from candlewick.functions.exprs import row_hash
from candlewick.functions.picks import exact_picks, pick_size
from candlewick.operators import clean as CL
from candlewick.operators import sampling as SM
from candlewick.operators.windows import trailing_count

SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@SETTINGS
@given(n=st.integers(1, 400), fraction=st.sampled_from([0.03, 0.05, 0.5]), minimum=st.integers(0, 12),
       cap=st.integers(0, 1), seed=st.integers(0, 99))
def test_exact_picks_equal_global_row_number(spark, n, fraction, minimum, cap, seed):
    df = spark.range(n).select(F.format_string("u%d", "id").alias("_uid"))
    picked = exact_picks(df, "_uid", seed, {"t": (fraction, minimum, cap)})
    have = {r[0] for r in picked.filter("_pick_t").select("_uid").collect()}
    k = pick_size(n, fraction, minimum, cap)
    ranked = df.withColumn("r", F.row_number().over(Window.orderBy(row_hash(seed, "t", F.col("_uid")))))
    want = {r[0] for r in ranked.filter(F.col("r") <= k).select("_uid").collect()}
    assert have == want and len(have) == k


@SETTINGS
@given(groups=st.lists(st.integers(0, 12), min_size=1, max_size=6), n=st.integers(1, 6), seed=st.integers(0, 9))
def test_stratified_sample_matches_brute_force(spark, groups, n, seed):
    rows = [(f"S{g}", f"{g}-{i}") for g, size in enumerate(groups) for i in range(size)]
    if not rows:
        return
    df = spark.createDataFrame(rows, "symbol string, u string")
    got = sorted(map(tuple, SM.stratified_sample(df, n, seed, uid=F.col("u")).collect()))
    h = {r["u"]: r["h"] for r in df.select("u", row_hash(seed, "sample", F.col("u")).alias("h")).collect()}
    want = []
    for g, size in enumerate(groups):
        members = sorted((h[f"{g}-{i}"], f"{g}-{i}") for i in range(size))[:n]
        want += [(f"S{g}", u) for _, u in members]
    assert got == sorted(want)


@SETTINGS
@given(offsets=st.lists(st.integers(0, 300_000_000), min_size=1, max_size=60), keys=st.integers(1, 3))
def test_trailing_count_matches_definition(spark, offsets, keys):
    base = dt.datetime(2024, 1, 1)
    rows = [(i, i % keys, base + dt.timedelta(microseconds=o)) for i, o in enumerate(offsets)]
    df = spark.createDataFrame(rows, "event_id long, k long, ts timestamp_ntz")
    got = {r["event_id"]: r["trailing_count"] for r in trailing_count(df, "ts", ["k"]).collect()}
    for i, k, t in rows:
        want = sum(1 for _, k2, t2 in rows if k2 == k and t - dt.timedelta(microseconds=59_999_999) <= t2 <= t)
        assert got[i] == want


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["A", "B"]), st.sampled_from(["1", "2", "x", None]),
                          st.sampled_from(["1", "-1", "y", None])), min_size=1, max_size=20))
def test_dedup_and_rule_filter_keep_null_rows(spark, rows):
    df = spark.createDataFrame(rows, "symbol string, open string, volume string")
    typed = CL.coerce_numeric(df, ["open", "volume"])
    dedup = CL.dedup_rows(typed)
    distinct = {tuple(r) for r in typed.collect()}
    assert dedup.count() == len(distinct)
    kept = {tuple(r) for r in CL.rule_filter(dedup).collect()}
    assert kept == {r for r in distinct if not (r[2] is not None and r[2] < 0)}
