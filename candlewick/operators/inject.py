"""Seeded defect injection: make a dirty all-text candle table to test the
cleaning rules on.

Each step picks an exact number of rows ``min(max(minimum, floor(n *
fraction)), n)`` by seeded hash (``functions.picks``), so the result does not
depend on partitioning and can be replayed in SQL. Candles may repeat: where an
identity is to be picked in part, its rows are told apart by their content,
and equal rows by their place in the written table. Steps run in the order
drop -> duplicate -> missing -> text -> bad times -> symbol variants ->
negative volumes; the last five only rewrite values, so their picks are all
computed in one pass over the same row set.

Rows carry an identity ``_uid`` while injecting (duplicates get ``uid#dup``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.functions.exprs import hash_choice, is_numeric_text
from candlewick.functions.picks import exact_picks, pick_cuts, pick_size, place_key, splits_ties
from candlewick.functions.text import text_uid
from candlewick.schema import (
    BAD_TIME_WORDS,
    INJECT_NUMERIC_COLUMNS,
    INJECT_SIZES,
    NUMERIC_TEXT_WORDS,
    SYMBOLS,
    TIME_COLUMNS,
    VOLUME_COLUMNS,
)
from candlewick.session import checkpoint_dir, cut_lineage, drop_table

UID = "_uid"
#: Place of a row among all rows; only there while rows are picked.
PLACE = "_place"
VALUE_STEPS = ("missing", "text", "bad_time", "symbol", "negative")


def with_uid(df: DataFrame, uid: Column | None = None) -> DataFrame:
    """Attach the row identity used by every pick (default symbol|interval|open_time)."""
    if UID in df.columns:
        return df
    return df.withColumn(UID, uid if uid is not None else text_uid())


def _row_digest(columns: Sequence[str]) -> Column:
    return F.md5(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("\\N")) for c in columns]))


def _copies(df: DataFrame, more: dict[str, Column] | None = None) -> DataFrame:
    """``df`` with a running number ``_at`` (from 1) among equal rows, and
    ``more`` columns of the distinct rows.

    Equal rows are first counted (combined map-side) and made again from the
    count in steps of bounded size over all tasks, so a group of copies of any
    size never meets in one task."""
    rows = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n")).withColumns(more or {})
    step = 10_000
    parts = rows.withColumn("_from", F.explode(F.expr(f"sequence(1L, _n, {step}L)")))
    spread = parts.where(f"_n <= {step}").unionByName(parts.where(f"_n > {step}").repartition(*df.columns, "_from"))
    return spread.withColumn("_at", F.explode(F.expr(f"sequence(_from, least(_n, _from + {step - 1}L))"))).drop("_n", "_from")


def with_unique_uid(df: DataFrame) -> DataFrame:
    """Row identities that stay unique where candles repeat, so that every
    repeated row has picks of its own. An identity that occurs once is itself;
    repeated ones get the hash of the whole row and, for equal rows, a running
    number."""
    if UID in df.columns:
        return df
    rows = _copies(df, {"_id": text_uid()})
    repeated = rows.groupBy("_id").agg(F.count(F.lit(1)).alias("_all")).where("_all > 1").select("_id", F.lit(True).alias("_again"))
    unique = F.concat("_id", F.lit("|"), _row_digest(df.columns), F.lit("#"), F.col("_at").cast("string"))
    return rows.join(repeated, "_id", "left").select(*df.columns, F.when(F.col("_again"), unique).otherwise(F.col("_id")).alias(UID))


def placed(df: DataFrame) -> DataFrame:
    """``df`` with identities and a place for every row, written once, so that
    places stay what they are. Without a shared folder places are running
    numbers among equal rows, which any later run finds again."""
    df = with_uid(df)
    if PLACE in df.columns:
        return df
    if checkpoint_dir(df.sparkSession) is None:
        return _copies(df).withColumnRenamed("_at", PLACE)
    return cut_lineage(df.withColumn(PLACE, F.monotonically_increasing_id()))


def _picked(df: DataFrame, seed: int, specs: dict[str, tuple[float, int, int]], n: int | None) -> DataFrame:
    """``df`` with identities and a column ``_pick_<step>`` per spec. Rows are
    given places (a table is written) only where an identity is picked in part."""
    df = with_uid(df)
    cuts = pick_cuts(df, F.col(UID), seed, specs, n)
    rows = placed(df) if splits_ties(cuts) else df
    ties = (_row_digest([c for c in df.columns if c not in (UID, PLACE)]), place_key(F.col(PLACE)))
    out = exact_picks(rows, UID, seed, specs, cuts=cuts, ties=ties)
    return out if PLACE in df.columns else out.drop(PLACE)


def _spec(step: str, cap_offset: int = 0):
    fraction, minimum = INJECT_SIZES[step]
    return (fraction, minimum, cap_offset)


def drop_rows(df: DataFrame, seed: int = 42, n: int | None = None) -> DataFrame:
    """Remove ``min(max(5, floor(3% n)), n-1)`` rows (``n`` counted if not given)."""
    picked = _picked(df, seed, {"drop": _spec("drop", 1)}, n)
    return picked.filter(~F.col("_pick_drop")).drop("_pick_drop")


def duplicate_rows(df: DataFrame, seed: int = 42, n: int | None = None) -> DataFrame:
    """Append copies of ``min(max(5, floor(3% n)), n)`` rows (``n`` counted if
    not given), as one projection over one scan."""
    df = with_uid(df)
    picked = _picked(df, seed, {"duplicate": _spec("duplicate")}, n)
    copy = F.concat(F.col(UID), F.lit("#dup"))
    uids = F.explode(F.when(F.col("_pick_duplicate"), F.array(F.col(UID), copy)).otherwise(F.array(F.col(UID))))
    return picked.select(*[c for c in df.columns if c != UID], uids.alias(UID)).select(*df.columns)


def sizes_after_rows_steps(n: int) -> tuple[int, int]:
    """Row counts after the drop step and after the duplicate step."""
    kept = n - pick_size(n, *_spec("drop", 1))
    return kept, kept + pick_size(kept, *_spec("duplicate"))


def _present(df: DataFrame, columns: Sequence[str]) -> list[str]:
    return [c for c in columns if c in df.columns]


def _set_one_column(
    df: DataFrame, picked: Column, columns: Sequence[str], value: Column, seed: int, tag: str
) -> DataFrame:
    """In picked rows, replace the value of one seeded-chosen column."""
    chosen = hash_choice(seed, f"{tag}:col", F.col(UID), list(columns))
    return df.withColumns(
        {c: F.when(picked & (chosen == c), value).otherwise(F.col(c)) for c in columns}
    )


def symbol_key(c="symbol") -> Column:
    """Canonical lookup key of a symbol: trimmed, upper-cased, '/' removed."""
    return F.replace(F.upper(F.trim(F.col(c))), F.lit("/"), F.lit(""))


def _apply_value_steps(
    df: DataFrame, seed: int, symbols: Sequence[str] | None, flags: bool
) -> DataFrame:
    """Rewrite values of rows flagged ``_pick_<step>`` (picks already attached)."""
    uid = F.col(UID)
    missing_cols = _present(df, list(INJECT_NUMERIC_COLUMNS) + list(TIME_COLUMNS))
    numeric_cols = _present(df, INJECT_NUMERIC_COLUMNS)
    time_cols = _present(df, TIME_COLUMNS)
    volume_cols = _present(df, VOLUME_COLUMNS)
    out = df
    if missing_cols:
        out = _set_one_column(out, F.col("_pick_missing"), missing_cols, F.lit(None).cast("string"), seed, "missing")
    if numeric_cols:
        word = hash_choice(seed, "text:word", uid, NUMERIC_TEXT_WORDS)
        out = _set_one_column(out, F.col("_pick_text"), numeric_cols, word, seed, "text")
    if time_cols:
        word = hash_choice(seed, "bad_time:word", uid, BAD_TIME_WORDS)
        out = _set_one_column(out, F.col("_pick_bad_time"), time_cols, word, seed, "bad_time")
    known = F.lit(False)
    if "symbol" in out.columns:
        key = symbol_key("symbol")
        known = key.isin(*symbols) if symbols is not None else (F.length(key) > 0)
        variant = hash_choice(
            seed,
            "symbol:variant",
            uid,
            [F.lower(key), F.concat(F.lit(" "), key, F.lit(" ")), F.replace(key, F.lit("USDT"), F.lit("/USDT"))],
        )
        hit = F.col("_pick_symbol") & F.coalesce(known, F.lit(False))
        out = out.withColumn("_hit_symbol", hit).withColumn(
            "symbol", F.when(F.col("_hit_symbol"), variant).otherwise(F.col("symbol"))
        )
    else:
        out = out.withColumn("_hit_symbol", F.lit(False))
    if volume_cols:
        chosen = hash_choice(seed, "negative:col", uid, volume_cols)
        picked = F.col("_pick_negative")
        negs = {}
        for c in volume_cols:
            cur = F.col(c)
            neg = F.when(
                F.coalesce(is_numeric_text(cur), F.lit(False)),
                F.concat(F.lit("-"), F.regexp_replace(F.trim(cur), r"^[+-]", "")),
            ).otherwise(F.lit("-999"))
            negs[c] = F.when(picked & (chosen == c), neg).otherwise(cur)
        out = out.withColumns(negs)
    picks = [f"_pick_{s}" for s in VALUE_STEPS]
    return out if flags else out.drop(*picks, "_hit_symbol")


def inject_values(
    df: DataFrame,
    steps: Sequence[str] = VALUE_STEPS,
    seed: int = 42,
    symbols: Sequence[str] | None = SYMBOLS,
    flags: bool = False,
    n: int | None = None,
) -> DataFrame:
    """Run the chosen value-rewriting steps (all picks from one pass)."""
    picked = _picked(df, seed, {s: _spec(s) for s in steps}, n)
    for s in VALUE_STEPS:
        if s not in steps:
            picked = picked.withColumn(f"_pick_{s}", F.lit(False))
    return _apply_value_steps(picked, seed, symbols, flags)


def inject_defects(
    df: DataFrame,
    seed: int = 42,
    symbols: Sequence[str] | None = SYMBOLS,
    keep_uid: bool = False,
    flags: bool = False,
    materialize: bool = True,
    shuffled: bool = False,
) -> DataFrame:
    """All steps in order. The input is written once to the shared checkpoint
    folder and counted; every later row count follows from it. The thresholds
    of each step are found by passes over that table (one hash per step comes
    to the driver), so the dirty table is one projection of it. That result is
    written too, as every profiling pass reads it again, and the input's table
    is deleted; ``materialize=False`` leaves both to consumers that read the
    result once (cleaning, sampling, summaries). ``shuffled`` puts the rows in
    the seeded order (a global sort; only of use right before a file is
    written). Building the result runs jobs."""
    base = placed(df)
    out = _all_steps(base, base.count(), seed, symbols, flags)
    out = seeded_order(out, seed) if shuffled else out
    out = out.drop(PLACE) if keep_uid else out.drop(UID, PLACE)
    if not materialize:
        return out
    result = cut_lineage(out)
    drop_table(base)
    return result


def _all_steps(base: DataFrame, n: int, seed: int, symbols: Sequence[str] | None, flags: bool) -> DataFrame:
    kept, final = sizes_after_rows_steps(n)
    rows = duplicate_rows(drop_rows(base, seed, n), seed, kept)
    return inject_values(rows, VALUE_STEPS, seed, symbols, flags=flags, n=final)


def injection_summary(df: DataFrame, seed: int = 42, symbols: Sequence[str] | None = SYMBOLS) -> DataFrame:
    """(metric, value) counts of every step, like the injector's printed
    summary: one pass over the flagged rows (rows dropped are those of the
    input that are neither left nor copies). The nine counts are computed here
    and the table behind them is deleted."""
    base = placed(df)
    n = base.count()
    flagged = _all_steps(base, n, seed, symbols, flags=True)
    one = flagged.agg(
        F.lit(n).cast("bigint").alias("original_rows"),
        F.count_if(F.col(UID).endswith("#dup")).alias("duplicated_rows"),
        F.count_if("_pick_missing").alias("missing_values"),
        F.count_if("_pick_text").alias("text_in_numeric_columns"),
        F.count_if("_pick_bad_time").alias("invalid_times"),
        F.count_if("_hit_symbol").alias("inconsistent_symbols"),
        F.count_if("_pick_negative").alias("negative_volumes"),
        F.count(F.lit(1)).alias("final_rows"),
    ).withColumn("dropped_rows", F.col("original_rows") + F.col("duplicated_rows") - F.col("final_rows"))
    counts = one.first()
    drop_table(base)
    return df.sparkSession.createDataFrame([(c, int(counts[c])) for c in one.columns], "metric string, value bigint")


def seeded_order(df: DataFrame, seed: int = 42, uid: Column | None = None) -> DataFrame:
    """Rows in a seeded pseudo-random order (the injector's final shuffle).

    A global sort on a hash key: range partitioning samples the key, and hash
    keys are uniform, so no partition is hot. Use only right before writing.
    """
    from candlewick.functions.exprs import row_hash

    key = row_hash(seed, "shuffle", uid if uid is not None else F.col(UID) if UID in df.columns else text_uid())
    return df.withColumn("_order", key).orderBy("_order").drop("_order")
