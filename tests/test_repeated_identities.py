"""Picks are exact where candles repeat: identities, and whole rows, occur many times."""

import pytest
from pyspark.sql import functions as F

from candlewick.functions.picks import exact_picks, pick_cuts, place_key, splits_ties
from candlewick.operators import inject as I

COLUMNS = ["symbol", "interval", "open_time", "open", "high", "low", "close", "volume", "close_time", "quote_volume", "trade_count"]


def candles(spark, n, identities, contents, parts):
    """``n`` rows over ``identities`` candles with ``contents`` different closes each."""
    i = F.col("id")
    return spark.range(n).repartition(parts).select(
        F.lit("BTCUSDT").alias("symbol"),
        F.lit("1h").alias("interval"),
        F.format_string("2026-01-01T%02d:00:00+00:00", i % identities).alias("open_time"),
        *[F.lit("1.50000000").alias(c) for c in ("open", "high", "low")],
        F.format_string("%d.00000000", (i / identities).cast("long") % contents).alias("close"),
        *[F.lit("2.00000000").alias(c) for c in ("volume",)],
        F.lit("2026-01-01T00:59:59+00:00").alias("close_time"),
        F.lit("3.00000000").alias("quote_volume"),
        F.lit("7").alias("trade_count"),
    )


def sizes(summary):
    return {r["metric"]: r["value"] for r in summary.collect()}


@pytest.mark.parametrize("identities,contents", [(20, 1), (20, 7), (1, 1), (1, 3)])
def test_every_step_has_the_size_that_the_law_says(spark, identities, contents):
    got = sizes(I.injection_summary(candles(spark, 1000, identities, contents, 4), symbols=None))
    assert got == {
        "original_rows": 1000, "dropped_rows": 30, "duplicated_rows": 29, "missing_values": 49, "text_in_numeric_columns": 39,
        "invalid_times": 29, "inconsistent_symbols": 39, "negative_volumes": 29, "final_rows": 999,
    }


@pytest.mark.parametrize("folder", [True, False])
def test_result_does_not_depend_on_partitioning(spark, folder, monkeypatch):
    from candlewick import session

    if not folder:
        monkeypatch.setattr(session, "checkpoint_dir", lambda s: None)
        monkeypatch.setattr(I, "checkpoint_dir", lambda s: None)
    a, b = (I.inject_defects(candles(spark, 1000, 20, 3, parts), symbols=None) for parts in (1, 9))
    assert sorted(map(tuple, a.collect()), key=repr) == sorted(map(tuple, b.collect()), key=repr)
    assert a.columns == COLUMNS and a.count() == 999


def test_single_steps_are_exact_and_keep_their_columns(spark):
    df = candles(spark, 1000, 20, 1, 3)
    assert I.drop_rows(df).count() == 970
    assert I.duplicate_rows(df).count() == 1030
    out = I.inject_values(df, ["missing", "negative"], flags=True)
    assert out.agg(F.count_if("_pick_missing"), F.count_if("_pick_negative")).first() == (50, 30)
    assert I.PLACE not in out.columns and set(COLUMNS) < set(out.columns)


def test_a_tie_that_nothing_tells_apart_is_an_error(spark):
    df = spark.range(100).select(F.lit("same").alias("u"), "id")
    with pytest.raises(ValueError, match="share an identity"):
        exact_picks(df, "u", 1, {"x": (0.1, 1, 0)})
    picked = exact_picks(df, "u", 1, {"x": (0.1, 1, 0)}, ties=(place_key(F.col("id")),))
    assert [r["id"] for r in picked.where("_pick_x").orderBy("id").collect()] == list(range(10))


def test_unique_identities_need_no_places(spark):
    df = spark.range(1000).select(F.col("id").cast("string").alias("u"))
    cuts = pick_cuts(df, F.col("u"), 42, {"a": (0.05, 1, 0), "none": (0.0, 0, 0)})
    assert set(cuts) == {"a"} and not splits_ties(cuts) and (cuts["a"].need, cuts["a"].ties) == (1, 1)


def test_places_far_apart(spark):
    """Places of many writer partitions, with gaps as Spark leaves them."""
    df = spark.range(500).select(F.lit("u").alias("u"), (F.col("id") % 5 * (1 << 33) + F.col("id")).alias("p"))
    picked = exact_picks(df, "u", 1, {"x": (0.5, 1, 0)}, ties=(place_key(F.col("p")),))
    want = sorted(i % 5 * (1 << 33) + i for i in range(500))[:250]
    assert sorted(r["p"] for r in picked.where("_pick_x").collect()) == want
