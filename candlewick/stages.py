"""The pipeline's stages, path in, path out: a messy copy of a candle file for
testing, cleaning with its reports, and the market summary. Each stage reads
and writes files on any file system that Spark reaches and deletes the scratch
tables it made."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession

from candlewick.functions.text import candles_to_text
from candlewick.operators.analytics import market_summary
from candlewick.operators.clean import clean_candles
from candlewick.operators.inject import inject_defects
from candlewick.operators.quality import quality_report, write_report
from candlewick.operators.sampling import sample_check_report, stratified_sample
from candlewick.schema import SYMBOLS
from candlewick.session import configure, table_scope
from candlewick.sources.files import read_candles_csv, read_cleaned_csv, read_messy_csv, write_csv, write_single_csv


def mess_csv(spark: SparkSession, source: str, target: str, *, seed: int = 42, symbols: Sequence[str] | None = SYMBOLS, bad_rows: str = "fail") -> int:
    """Clean candle CSV -> messy CSV in seeded order; returns its row count,
    which is checked in the pass that writes it."""
    configure(spark)
    with table_scope(spark):
        messy = inject_defects(candles_to_text(read_candles_csv(spark, source, bad_rows=bad_rows)), seed, symbols, shuffled=True)
        rows = messy.count()  # of the written table
        write_csv(messy, target, expected=rows)
    return rows


def clean_csv(
    spark: SparkSession,
    source: str,
    cleaned: str,
    report: str | None = None,
    sample_report: str | None = None,
    *,
    n: int = 5,
    seed: int = 1,
    strict: bool = False,
    dedup_keys: Sequence[str] | None = None,
    bad_rows: str = "keep",
) -> None:
    """Messy CSV -> cleaned CSV (typed columns, derived features) and, where a
    path is given, the before/after report as text and the check report of a
    sample of ``n`` rows per symbol as one CSV. Raises ``ValueError`` where the
    source has no rows."""
    configure(spark)
    with table_scope(spark):
        raw = read_messy_csv(spark, source, require_rows=True, bad_rows=bad_rows)
        out = clean_candles(raw, strict=strict, dedup_keys=dedup_keys)
        write_csv(out, cleaned)
        if report is not None:
            write_report(quality_report(raw, strict=strict, dedup_keys=dedup_keys), report)
        if sample_report is not None:
            write_single_csv(sample_check_report(stratified_sample(out, n=n, seed=seed), n), sample_report, order_by=["seq", "metric"])


def summarise_csv(spark: SparkSession, cleaned: str, summary: str) -> None:
    """Cleaned CSV -> one CSV row per symbol, in the order of activity."""
    configure(spark)
    with table_scope(spark):
        write_single_csv(market_summary(read_cleaned_csv(spark, cleaned)), summary, order_by=["activity_rank"])
