"""Injection, cleaning, profiling and sampling queries.

The dirty input is made the way the original pipeline made it: candles ->
text -> seeded defect injection. Candle symbols here are not the ten known
exchange symbols, so symbol variants apply to every non-empty symbol.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from candlewick.functions.text import candles_to_text
from candlewick.operators import clean as CL
from candlewick.operators import inject as I
from candlewick.operators import quality as Q
from candlewick.plans import sql as S
from candlewick.plans import sql_clean as X
from candlewick.plans.registry import event_candles, query
from candlewick.schema import CANDLE_COLUMNS, NUMERIC_COLUMNS
from candlewick.session import checkpoint_dir, scratch_path
from candlewick.sources.files import csv_rejects

SEED = 42
SAMPLE_SEED = 1
C = [("candles", S.CANDLES)]
TEXT = C + [("m_text", X.text_of("candles")), ("m_uid", X.with_uid("m_text"))]
MESSY = C + X.messy_ctes("candles", SEED, None)
CLEAN = MESSY + X.clean_ctes()
SAMPLE = CLEAN + X.sample_ctes("cleaned", 5, SAMPLE_SEED)
TC = X.TEXT_COLS


def event_text(spark, sf, interval="1h"):
    return candles_to_text(event_candles(spark, sf, interval))


def messy(spark, sf, interval="1h", materialize=True):
    return I.inject_defects(event_text(spark, sf, interval), SEED, symbols=None, materialize=materialize)


def cleaned(spark, sf, interval="1h", **kw):
    # Measured: cleaning the materialised dirty table is not slower than
    # cleaning it inline (the inline plan re-runs the value-step subquery).
    return CL.clean_candles(messy(spark, sf, interval), **kw)


def messy_sql_ctes(interval="1h"):
    return [("candles", S.candles_sql(interval))] + X.messy_ctes("candles", SEED, None)


def clean_sql_ctes(interval="1h"):
    return messy_sql_ctes(interval) + X.clean_ctes()


# --- injection ------------------------------------------------------------


@query("candles_to_text", S.with_ctes(TEXT, f"SELECT {TC} FROM m_text"))
def q_text(spark, sf):
    return event_text(spark, sf)


@query("inject_drop", S.with_ctes(TEXT + X.drop_ctes("m_uid", SEED), f"SELECT {TC} FROM i_drop"))
def q_drop(spark, sf):
    return I.drop_rows(event_text(spark, sf), SEED).drop(I.UID)


@query("inject_duplicates", S.with_ctes(TEXT + X.dup_ctes("m_uid", SEED), f"SELECT {TC} FROM i_dup"))
def q_dup(spark, sf):
    return I.duplicate_rows(event_text(spark, sf), SEED).drop(I.UID)


def _value_query(name, step):
    sql = S.with_ctes(TEXT + X.value_ctes("m_uid", [step], SEED, None), f"SELECT {TC} FROM i_val")

    def fn(spark, sf):
        return I.inject_values(event_text(spark, sf), [step], SEED, symbols=None).drop(I.UID)

    query(name, sql)(fn)


_value_query("inject_missing", "missing")
_value_query("inject_text", "text")
_value_query("inject_bad_times", "bad_time")
_value_query("inject_symbol_variants", "symbol")
_value_query("inject_negative", "negative")


KNOWN = ("CLICKUSDT", "VIEWUSDT")


@query(
    "inject_symbol_variants_known",
    S.with_ctes(TEXT + X.value_ctes("m_uid", ["symbol"], SEED, KNOWN), f"SELECT {TC} FROM i_val"),
)
def q_symbols_known(spark, sf):
    """Variants only of the symbols on a list; other picked rows stay as they are."""
    return I.inject_values(event_text(spark, sf), ["symbol"], SEED, symbols=KNOWN).drop(I.UID)


@query("inject_defects", S.with_ctes(MESSY, "SELECT * FROM messy"))
def q_messy(spark, sf):
    return messy(spark, sf)


def _summary_sql(ctes, source):
    return S.with_ctes(
        ctes,
        f"""SELECT metric, value FROM (
  SELECT 'original_rows' AS metric, (SELECT count(*) FROM {source}) AS value
  UNION ALL SELECT 'dropped_rows', (SELECT count(*) FROM {source}) - (SELECT count(*) FROM i_drop)
  UNION ALL SELECT 'duplicated_rows', (SELECT count(*) FROM i_dup WHERE _uid LIKE '%#dup')
  UNION ALL SELECT 'missing_values', (SELECT count(*) FROM i_val WHERE _pick_missing)
  UNION ALL SELECT 'text_in_numeric_columns', (SELECT count(*) FROM i_val WHERE _pick_text)
  UNION ALL SELECT 'invalid_times', (SELECT count(*) FROM i_val WHERE _pick_bad_time)
  UNION ALL SELECT 'inconsistent_symbols', (SELECT count(*) FROM i_val WHERE _hit_symbol)
  UNION ALL SELECT 'negative_volumes', (SELECT count(*) FROM i_val WHERE _pick_negative)
  UNION ALL SELECT 'final_rows', (SELECT count(*) FROM i_val)) s""",
    )


@query("injection_summary", _summary_sql(MESSY[:-1], "m_uid"))
def q_inject_summary(spark, sf):
    return I.injection_summary(event_text(spark, sf), SEED, symbols=None)


# Candles that repeat: all of them, those of even hours twice more (equal rows)
# and those of odd hours once more with another close (same identity).
_REPEATED = """SELECT * FROM m_text UNION ALL SELECT m_text.* FROM m_text, (VALUES (1), (2)) v(i)
WHERE CAST(substr(open_time, 12, 2) AS INTEGER) % 2 = 0
UNION ALL SELECT * REPLACE ('1.00000000' AS close) FROM m_text WHERE CAST(substr(open_time, 12, 2) AS INTEGER) % 2 = 1"""
_IDENTITY = "coalesce(symbol, '\\N') || '|' || coalesce(\"interval\", '\\N') || '|' || coalesce(open_time, '\\N')"
_WHOLE = "md5(" + " || '|' || ".join(f"coalesce({X.qi(c)}, '\\N')" for c in CANDLE_COLUMNS) + ")"


@query(
    "inject_drop_repeated",
    S.with_ctes(
        TEXT[:-1]
        + [
            ("r_all", _REPEATED),
            ("r_id", f"SELECT *, {_IDENTITY} AS _id, {_WHOLE} AS _row FROM r_all"),
            (
                "r_uid",
                "SELECT * EXCLUDE (_id, _row), CASE WHEN count(*) OVER (PARTITION BY _id) = 1 THEN _id ELSE _id || '|' || _row "
                "|| '#' || CAST(row_number() OVER (PARTITION BY _id, _row) AS VARCHAR) END AS _uid FROM r_id",
            ),
        ]
        + X.drop_ctes("r_uid", SEED),
        f"SELECT {TC} FROM i_drop",
    ),
)
def q_drop_repeated(spark, sf):
    """Dropping rows from a table in which candles repeat, every repeated row
    with an identity of its own: exactly as many go as the fraction says."""
    return I.drop_rows(I.with_unique_uid(repeated_text(spark, sf)), SEED).drop(I.UID)


def repeated_text(spark, sf):
    """The rows of ``_REPEATED``: neither identities nor whole rows are unique."""
    text = event_text(spark, sf)
    hour = F.substring("open_time", 12, 2).cast("int")
    even, odd = text.where(hour % 2 == 0), text.where(hour % 2 == 1)
    return text.unionByName(even).unionByName(even).unionByName(odd.withColumn("close", F.lit("1.00000000")))


# The default identity over repeated candles: rows of one identity in the order
# of their content, equal rows one after the other (any of them is as good).
_TIES = ", _w, _ord"
_REPEATED_STEPS = (
    TEXT[:-1]
    + [
        ("r_all", _REPEATED),
        ("r_uid", f"SELECT *, {_IDENTITY} AS _uid, {_WHOLE} AS _w, row_number() OVER (ORDER BY {_WHOLE}) AS _ord FROM r_all"),
    ]
    + X.drop_ctes("r_uid", SEED, ties=_TIES)
    + X.dup_ctes("i_drop", SEED, ties=_TIES)
    + X.value_ctes("i_dup", X.VALUE_STEPS, SEED, None, ties=_TIES)
)


@query("inject_defects_repeated", S.with_ctes(_REPEATED_STEPS, f"SELECT {TC} FROM i_val"))
def q_messy_repeated(spark, sf):
    """All steps, default identity, on a table in which candles repeat."""
    return I.inject_defects(repeated_text(spark, sf), SEED, symbols=None)


@query("injection_summary_repeated", _summary_sql(_REPEATED_STEPS, "r_uid"))
def q_inject_summary_repeated(spark, sf):
    """Every step has exactly the size that the fractions say."""
    return I.injection_summary(repeated_text(spark, sf), SEED, symbols=None)


# Every fifth hour's row lacks its last field, the next hour's row has one too many.
_SPOILED = "CAST(substr(open_time, 12, 2) AS INTEGER) % 5"


@query(
    "csv_reject_report",
    S.with_ctes(
        TEXT[:-1],
        f"""SELECT CASE {_SPOILED} WHEN 0 THEN 'short' ELSE 'long' END AS kind,
       CAST({len(CANDLE_COLUMNS)} + CASE {_SPOILED} WHEN 0 THEN -1 ELSE 1 END AS INTEGER) AS fields, count(*) AS n
FROM m_text WHERE {_SPOILED} < 2 GROUP BY ALL""",
    ),
)
def q_csv_rejects(spark, sf):
    """The candles as CSV files with spoiled rows, read back for what is refused."""
    spoiled = F.substring("open_time", 12, 2).cast("int") % 5
    values = F.array_join(F.array(*[F.col(c) for c in CANDLE_COLUMNS[:-1]]), ",", "")
    last = F.when(spoiled == 0, "").otherwise(F.concat(F.lit(","), F.col(CANDLE_COLUMNS[-1])))
    line = F.concat(values, last, F.when(spoiled == 1, ",more").otherwise(""))
    path = scratch_path(spark, checkpoint_dir(spark))
    # one column whose name is the header line; the separator never occurs
    event_text(spark, sf).select(line.alias(",".join(CANDLE_COLUMNS))).write.option("header", True).option("sep", "\u0001").option("quote", "\u0000").csv(path)
    return csv_rejects(spark, path).groupBy("kind", "fields").agg(F.count(F.lit(1)).alias("n"))


# --- coercion and profiling ------------------------------------------------


@query(
    "symbol_canonical",
    S.with_ctes(
        MESSY,
        f"SELECT symbol AS symbol_raw, {X.clean_symbol('symbol')} AS symbol, count(*) AS n "
        "FROM messy GROUP BY ALL",
    ),
)
def q_symbol(spark, sf):
    from candlewick.functions.exprs import clean_symbol

    return (
        messy(spark, sf)
        .groupBy(F.col("symbol").alias("symbol_raw"), clean_symbol("symbol").alias("symbol"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


_NUM = [c for c in NUMERIC_COLUMNS if c in CANDLE_COLUMNS]


@query(
    "numeric_safe_cast",
    S.with_ctes(
        MESSY,
        "SELECT " + ", ".join(f"{c} AS {c}_raw, {X.safe_double(c)} AS {c}" for c in _NUM) + " FROM messy",
    ),
)
def q_numeric(spark, sf):
    from candlewick.functions.exprs import safe_double

    return messy(spark, sf).select(
        *[e for c in _NUM for e in (F.col(c).alias(f"{c}_raw"), safe_double(c).alias(c))]
    )


@query(
    "timestamp_safe_cast",
    S.with_ctes(
        MESSY,
        "SELECT open_time AS open_time__orig, "
        f"{X.safe_ts('open_time')} AS open_time, close_time AS close_time__orig, "
        f"{X.safe_ts('close_time')} AS close_time FROM messy",
    ),
)
def q_ts(spark, sf):
    from candlewick.functions.exprs import safe_timestamp

    return messy(spark, sf).select(
        F.col("open_time").alias("open_time__orig"),
        safe_timestamp("open_time").alias("open_time"),
        F.col("close_time").alias("close_time__orig"),
        safe_timestamp("close_time").alias("close_time"),
    )


_NULLS = " UNION ALL ".join(
    f"SELECT {X.q(c)} AS \"column\", count(*) - count({X.q(c)[1:-1] if c != 'interval' else '\"interval\"'}) AS missing FROM messy"
    for c in CANDLE_COLUMNS
)


@query("null_profile", S.with_ctes(MESSY + [("nulls", _NULLS)], 'SELECT "column", missing FROM nulls WHERE missing > 0'))
def q_null_profile(spark, sf):
    return Q.null_profile(messy(spark, sf))


@query(
    "most_affected_column",
    S.with_ctes(
        MESSY + [("nulls", _NULLS)],
        'SELECT "column", missing FROM nulls WHERE missing > 0 ORDER BY missing DESC, "column" LIMIT 1',
    ),
)
def q_most_affected(spark, sf):
    return Q.most_affected_column(messy(spark, sf))


@query(
    "invalid_numeric_rows",
    S.with_ctes(
        MESSY,
        "SELECT count(*) AS invalid_numeric_rows FROM messy WHERE "
        + " OR ".join(f"{X.safe_double(c)} IS NULL" for c in _NUM),
    ),
)
def q_invalid_numeric(spark, sf):
    return Q.invalid_numeric_rows(messy(spark, sf))


@query(
    "invalid_timestamps",
    S.with_ctes(
        MESSY,
        " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", CAST(count_if({c} IS NULL) AS BIGINT) AS missing, "
            f"CAST(count_if({c} IS NOT NULL AND {X.safe_ts(c)} IS NULL) AS BIGINT) AS unparsable, "
            f"CAST(count_if({X.safe_ts(c)} IS NULL) AS BIGINT) AS invalid FROM messy"
            for c in ("open_time", "close_time")
        ),
    ),
)
def q_invalid_ts(spark, sf):
    return Q.invalid_timestamps(messy(spark, sf))


@query(
    "duplicate_count",
    S.with_ctes(
        CLEAN, "SELECT (SELECT count(*) FROM c_typed) - (SELECT count(*) FROM c_dedup) AS duplicates"
    ),
)
def q_dup_count(spark, sf):
    return Q.duplicate_count(messy(spark, sf))


@query(
    "duplicate_mask",
    S.with_ctes(
        CLEAN,
        "SELECT *, row_number() OVER (PARTITION BY " + ", ".join(X.qi(c) for c in [*CANDLE_COLUMNS, "open_time__orig", "close_time__orig"]) + ") > 1 AS is_duplicate FROM c_typed",
    ),
)
def q_dup_mask(spark, sf):
    """Every row after the first of equal rows is marked."""
    return CL.duplicate_mask(CL.coerce(messy(spark, sf)))


@query("dedup_rows", S.with_ctes(CLEAN, "SELECT * FROM c_dedup"))
def q_dedup(spark, sf):
    return CL.dedup_rows(CL.coerce(messy(spark, sf)))


_RAW_TB = "md5(" + " || '|' || ".join(
    f"coalesce({'\"interval\"' if c == 'interval' else c}, '\\N')"
    for c in CANDLE_COLUMNS
) + ")"


def dedup_key_sql(messy_ctes) -> str:
    return S.with_ctes(
        messy_ctes
        + [
            ("k_raw", f"SELECT *, {_RAW_TB} AS _tb FROM messy"),
            ("k_typed", X.typed_of("k_raw").replace(" FROM k_raw", ", _tb FROM k_raw")),
        ],
        """SELECT * EXCLUDE (_rn, _tb) FROM (
  SELECT *, row_number() OVER (PARTITION BY symbol, "interval", open_time ORDER BY
    ((symbol IS NULL)::INT + ("interval" IS NULL)::INT + (open_time IS NULL)::INT + (open IS NULL)::INT
     + (high IS NULL)::INT + (low IS NULL)::INT + (close IS NULL)::INT + (volume IS NULL)::INT
     + (close_time IS NULL)::INT + (quote_volume IS NULL)::INT + (trade_count IS NULL)::INT
     + (open_time__orig IS NULL)::INT + (close_time__orig IS NULL)::INT), _tb) AS _rn
  FROM k_typed) s WHERE _rn = 1""",
    )


def dedup_key_spark(raw):
    cols = raw.columns
    raw = raw.withColumn(
        "_tb", F.md5(F.concat_ws("|", *[F.coalesce(F.col(c), F.lit("\\N")) for c in cols]))
    )
    typed = CL.coerce(raw)
    # Fewest nulls wins; ties go to the smallest md5 of the raw row text.
    return CL.dedup_by_key(typed, CL.CANDLE_KEY, tiebreak=F.col("_tb")).drop("_tb")


@query("dedup_by_candle_key", dedup_key_sql(MESSY))
def q_dedup_key(spark, sf):
    return dedup_key_spark(messy(spark, sf))


@query(
    "rule_violation_counts",
    S.with_ctes(
        CLEAN,
        " UNION ALL ".join(
            f"SELECT '{n}' AS metric, CAST(count_if({e}) AS BIGINT) AS value FROM c_dedup"
            for n, e in list(X.RULES.items()) + [("rows_removed", X.any_rule())]
        )
        + " UNION ALL SELECT 'rule_hits', CAST("
        + " + ".join(f"count_if({e})" for e in X.RULES.values())
        + " AS BIGINT) FROM c_dedup",
    ),
)
def q_rules(spark, sf):
    return Q.rule_violation_counts(CL.dedup_rows(CL.coerce(messy(spark, sf))))


@query(
    "rule_filter_null_safe",
    S.with_ctes(CLEAN, "SELECT * FROM c_kept"),
)
def q_rule_filter(spark, sf):
    return CL.rule_filter(CL.dedup_rows(CL.coerce(messy(spark, sf))))


@query("clean_candles", S.with_ctes(CLEAN, "SELECT * FROM cleaned"))
def q_clean(spark, sf):
    return cleaned(spark, sf)


@query(
    "clean_candles_strict",
    S.with_ctes(MESSY + X.clean_ctes("messy", strict=True), "SELECT * FROM cleaned"),
)
def q_clean_strict(spark, sf):
    return cleaned(spark, sf, strict=True)
