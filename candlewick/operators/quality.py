"""Data-quality profiling: null counts, invalid values, duplicates, rule hits
and the before/after report.

The report needs one pass: the aggregate that de-duplicates the rows carries
the counts of the raw table (copies, missing and repaired values) along.
Results are long (metric, value) DataFrames built from one-row aggregates: no
joins, nothing collected.
``render_report`` formats the bounded report on the driver, ``write_report``
writes it.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.functions.exprs import clean_symbol, safe_double, safe_timestamp
from candlewick.operators import clean as C
from candlewick.schema import NUMERIC_COLUMNS, QUALITY_DECISION_REST, QUALITY_REPORT_LINES, RULE_TEXTS, TIME_COLUMNS


def _long(one_row: DataFrame, names: Sequence[str], prefix: str = "") -> DataFrame:
    """One-row aggregate -> (metric, value) rows, in ``names`` order (with ``seq``)."""
    return one_row.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(i).alias("seq"),
                        F.lit(prefix + n).alias("metric"),
                        F.col(n).cast("bigint").alias("value"),
                    )
                    for i, n in enumerate(names)
                ]
            )
        )
    )


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, missing) for every column, one aggregate pass."""
    cols = list(columns) if columns is not None else df.columns
    one = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return _long(one, cols).select(F.col("metric").alias("column"), F.col("value").alias("missing"), "seq")


def null_profile(df: DataFrame) -> DataFrame:
    """Columns with missing values, most affected first (ties by name)."""
    return (
        null_counts(df)
        .filter(F.col("missing") > 0)
        .select("column", "missing")
        .orderBy(F.col("missing").desc(), F.col("column"))
    )


def most_affected_column(df: DataFrame) -> DataFrame:
    return null_profile(df).limit(1)


def missing_map(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row: ``missing`` as map<column, count> (the report's dictionary form)."""
    cols = list(columns) if columns is not None else df.columns
    return df.agg(
        F.map_from_arrays(
            F.array(*[F.lit(c) for c in cols]),
            F.array(*[F.count_if(F.col(c).isNull()) for c in cols]),
        ).alias("missing")
    )


def count_check(df: DataFrame, expected: int, by: str = "symbol") -> DataFrame:
    """Per group: rows, expected rows and whether they agree."""
    return df.groupBy(by).agg(F.count(F.lit(1)).alias("n")).select(
        by, "n", F.lit(expected).cast("bigint").alias("expected"), (F.col("n") == expected).alias("ok")
    )


def expect_count(df: DataFrame, expected: int) -> int:
    """Raise ``ValueError`` unless ``df`` has ``expected`` rows (one count job)."""
    n = df.count()
    if n != expected:
        raise ValueError(f"record count check failed: {n} rows, expected {expected}")
    return n


def _numeric_present(df: DataFrame) -> list[str]:
    return [c for c in NUMERIC_COLUMNS if c in df.columns]


def _time_present(df: DataFrame) -> list[str]:
    return [c for c in TIME_COLUMNS if c in df.columns]


def invalid_numeric_rows(raw: DataFrame) -> DataFrame:
    """Rows with at least one numeric value missing or unparsable."""
    bad = F.lit(False)
    for c in _numeric_present(raw):
        bad = bad | safe_double(c).isNull()
    return raw.agg(F.count_if(bad).alias("invalid_numeric_rows"))


def invalid_timestamps(raw: DataFrame) -> DataFrame:
    """Per time column: missing, unparsable (text present, no time) and both.

    One aggregate pass for all time columns, then one row per column."""
    cols = _time_present(raw)
    aggs = []
    for c in cols:
        parsed = safe_timestamp(c)
        aggs += [
            F.count_if(F.col(c).isNull()).alias(f"{c}:missing"),
            F.count_if(F.col(c).isNotNull() & parsed.isNull()).alias(f"{c}:unparsable"),
            F.count_if(parsed.isNull()).alias(f"{c}:invalid"),
        ]
    one = raw.agg(*aggs)
    return one.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(c).alias("column"),
                        F.col(f"`{c}:missing`").alias("missing"),
                        F.col(f"`{c}:unparsable`").alias("unparsable"),
                        F.col(f"`{c}:invalid`").alias("invalid"),
                    )
                    for c in cols
                ]
            )
        )
    )


def duplicate_count(raw: DataFrame) -> DataFrame:
    """Rows equal to an earlier row after coercion: the copies beyond the
    first of every distinct row, from one aggregate."""
    typed = C.coerce(raw)
    rows = typed.groupBy(*typed.columns).agg((F.count(F.lit(1)) - 1).alias("n"))
    return rows.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("duplicates"))


def rule_violation_counts(typed: DataFrame, strict: bool = False) -> DataFrame:
    """Rows hitting each rule, their sum and the rows removed (union of rules)."""
    rules = C.rule_columns(typed, strict)
    one = typed.agg(
        *[F.count_if(r).alias(n) for n, r in rules.items()],
        sum((F.count_if(r) for r in rules.values()), F.lit(0)).alias("rule_hits"),
        F.count_if(C.violates_any(typed, strict)).alias("rows_removed"),
    )
    names = list(rules) + ["rule_hits", "rows_removed"]
    return _long(one, names).select("metric", "value")


def invalid_numbers(raw: DataFrame) -> DataFrame:
    """Per numeric column: missing, unparsable (text present, no number) and
    both, one aggregate pass."""
    cols = _numeric_present(raw)
    one = raw.agg(
        *[F.count_if(F.col(c).isNull()).alias(f"{c}:missing") for c in cols],
        *[F.count_if(F.col(c).isNotNull() & safe_double(c).isNull()).alias(f"{c}:unparsable") for c in cols],
    )
    rows = [
        F.struct(
            F.lit(c).alias("column"),
            F.col(f"`{c}:missing`").alias("missing"),
            F.col(f"`{c}:unparsable`").alias("unparsable"),
            (F.col(f"`{c}:missing`") + F.col(f"`{c}:unparsable`")).alias("invalid"),
        )
        for c in cols
    ]
    return one.select(F.inline(F.array(*rows)))


def repaired(raw: DataFrame) -> Column:
    """A row that coercion changes: another spelling of the symbol, or a number
    or time text that becomes null."""
    out = F.lit(False)
    if "symbol" in raw.columns:
        out = out | F.coalesce(F.col("symbol") != clean_symbol("symbol"), F.lit(False))
    for c in _numeric_present(raw):
        out = out | (F.col(c).isNotNull() & safe_double(c).isNull())
    for c in _time_present(raw):
        out = out | (F.col(c).isNotNull() & safe_timestamp(c).isNull())
    return out


def decision_text(rules: Sequence[str]) -> str:
    """What the cleaner does, from the rules that are active."""
    said = [RULE_TEXTS.get(r, r.replace("_", " ")) for r in rules]
    listed = said[0] if len(said) == 1 else ", ".join(said[:-1]) + " or " + said[-1] if said else "no rule"
    return f"rows with {listed} are dropped; {QUALITY_DECISION_REST}"


def _explode(one_row: DataFrame, items: Sequence[tuple[int, str, Column]]) -> DataFrame:
    """One-row aggregate -> (seq, metric, value) rows."""
    return one_row.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(seq).alias("seq"), F.lit(m).alias("metric"), v.cast("bigint").alias("value"))
                    for seq, m, v in items
                ]
            )
        )
    )


def quality_report(
    raw: DataFrame,
    *,
    strict: bool = False,
    dedup_keys: Sequence[str] | None = None,
) -> DataFrame:
    """Before/after report as (seq, metric, value), mirroring ``clean_candles``.

    One scan and one shuffle of the rows: the aggregate that de-duplicates the
    typed rows also counts, per distinct row, its copies and what coercion hid
    in them (missing numbers, repaired rows). All else follows from the typed
    row, so the counts before cleaning are sums over its groups. The cleaned
    table's rows are grouped once more, in the same partitions, so
    ``duplicates_after`` is measured rather than assumed. With ``dedup_keys``
    the rows kept are picked in a branch of their own, which reads ``raw``
    again.
    """
    from candlewick.operators.analytics import derive_candle_features

    raw_cols, numbers, times = raw.columns, _numeric_present(raw), _time_present(raw)
    hidden = {f"_m{i}": F.col(c).isNull() for i, c in enumerate(numbers)} | {"_fixed": repaired(raw)}
    counted = raw.withColumns({n: F.coalesce(e, F.lit(False)).cast("bigint") for n, e in hidden.items()})
    typed = C.coerce(counted)
    rows = typed.groupBy(*[c for c in typed.columns if c not in hidden]).agg(F.count(F.lit(1)).alias("_copies"), *[F.sum(n).alias(n) for n in hidden])
    featured = derive_candle_features(rows)
    extra = ("_copies", *hidden)
    clean_cols = [c for c in featured.columns if c not in extra]
    grouped = featured.groupBy(*clean_cols).agg(F.count(F.lit(1)).alias("_rows"), *[F.sum(c).alias(c) for c in extra])
    rules = C.rule_columns(typed, strict)
    removed = C.violates_any(typed, strict)

    def copies_where(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("_copies"))), F.lit(0))

    def rows_where(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("_rows"))), F.lit(0))

    def missing(c: str) -> Column:
        """Copies of a row whose raw value is missing."""
        if c in numbers:
            return F.coalesce(F.sum(f"_m{numbers.index(c)}"), F.lit(0))
        return copies_where(F.col(f"{c}__orig" if c in times else c).isNull())

    no_number = reduce(or_, [F.col(c).isNull() for c in numbers], F.lit(False))
    one: dict[str, Column] = {"rows_before": F.coalesce(F.sum("_copies"), F.lit(0))}
    one |= {f"b{i}": missing(c) for i, c in enumerate(raw_cols)}
    one |= {f"n{i}": copies_where(F.col(c).isNull()) - missing(c) for i, c in enumerate(numbers)}
    one |= {f"t{i}": copies_where(F.col(f"{c}__orig").isNotNull() & F.col(c).isNull()) for i, c in enumerate(times)}
    one |= {"invalid_numeric_rows": copies_where(no_number), "rows_repaired": F.coalesce(F.sum("_fixed"), F.lit(0))}
    two: dict[str, Column] = {
        "rows_deduped": F.coalesce(F.sum("_rows"), F.lit(0)),
        "rows_after": rows_where(~removed),
        "distinct_after": F.count_if(~removed),
        "rule_removed": rows_where(removed),
    }
    two |= {f"r{i}": rows_where(r) for i, r in enumerate(rules.values())}
    two |= {f"a{i}": rows_where(~removed & F.col(c).isNull()) for i, c in enumerate(clean_cols)}
    zero = F.lit(0).cast("bigint")

    def of(df: DataFrame, aggregates: dict[str, Column]) -> DataFrame:
        return df.agg(*[e.cast("bigint").alias(n) for n, e in aggregates.items()])

    if dedup_keys:
        kept = derive_candle_features(C.dedup_by_key(C.coerce(raw), dedup_keys)).groupBy(*clean_cols).agg(F.count(F.lit(1)).alias("_rows"))
        first = of(grouped, one).select(*one, *[zero.alias(n) for n in two])
        second = of(kept, two).select(*[zero.alias(n) for n in one], *two)
        facts = first.unionByName(second).agg(*[F.sum(n).alias(n) for n in (*one, *two)])
    else:
        facts = of(grouped, one | two)

    def total(prefix: str, n: int) -> Column:
        return sum((F.col(f"{prefix}{i}") for i in range(n)), zero)

    items = [
        (0, "rows_before", F.col("rows_before")),
        (1, "rows_after", F.col("rows_after")),
        (199, "missing_before_total", total("b", len(raw_cols))),
        (299, "missing_after_total", total("a", len(clean_cols))),
        (300, "duplicates_before", F.col("rows_before") - F.col("rows_deduped")),
        (301, "duplicates_after", F.col("rows_after") - F.col("distinct_after")),
        (302, "rule_removed", F.col("rule_removed")),
        (390, "rule_hits", total("r", len(rules))),
        (400, "invalid_numeric_rows", F.col("invalid_numeric_rows")),
        (401, "rows_repaired", F.col("rows_repaired")),
    ]
    items += [(100 + i, f"missing_before:{c}", F.col(f"b{i}")) for i, c in enumerate(raw_cols)]
    items += [(200 + i, f"missing_after:{c}", F.col(f"a{i}")) for i, c in enumerate(clean_cols)]
    items += [(303 + i, n, F.col(f"r{i}")) for i, n in enumerate(rules)]
    items += [(410 + i, f"unparsable:{c}", F.col(f"n{i}")) for i, c in enumerate(numbers)]
    items += [(430 + i, f"unparsable:{c}", F.col(f"t{i}")) for i, c in enumerate(times)]
    return _explode(facts, items)


def render_report(report: DataFrame) -> str:
    """Text form of the (bounded, ~50-row) report, rendered on the driver."""
    rows = sorted(report.collect(), key=lambda r: r["seq"])
    vals = {r["metric"]: r["value"] for r in rows}

    def of(prefix: str) -> dict:
        return {r["metric"][len(prefix) :]: r["value"] for r in rows if r["metric"].startswith(prefix)}

    rules = [r["metric"] for r in rows if 303 <= r["seq"] < 390]
    values = [
        None,
        vals.get("rows_before"),
        vals.get("rows_after"),
        of("missing_before:"),
        of("missing_after:"),
        vals.get("duplicates_before"),
        vals.get("duplicates_after"),
        vals.get("rule_removed"),
        vals.get("negative_volume"),
        vals.get("negative_trade_count"),
        vals.get("high_lt_low"),
        decision_text(rules),
    ]
    lines = [fmt.format(v) if v is not None or "{}" in fmt else fmt for fmt, v in zip(QUALITY_REPORT_LINES, values)]
    lines[-1:-1] = [f"{RULE_TEXTS.get(r, r)}: {vals[r]}" for r in rules if r not in ("negative_volume", "negative_trade_count", "high_lt_low")]
    lines[-1:-1] = [
        f"Rule hits in all: {vals.get('rule_hits')}",
        f"Rows with an invalid number: {vals.get('invalid_numeric_rows')}",
        f"Unparsable values (per column): {of('unparsable:')}",
        f"Rows repaired: {vals.get('rows_repaired')}",
    ]
    return "\n".join(lines)


def write_report(report: DataFrame, path: str) -> str:
    """The report's text form as one UTF-8 file at ``path`` (overwritten), on
    any file system that Spark writes to."""
    text = render_report(report) + "\n"
    spark = report.sparkSession
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = place.getFileSystem(spark._jsc.hadoopConfiguration()).create(place, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    return path
