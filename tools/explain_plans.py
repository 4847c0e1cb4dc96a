"""Write PLANS.md: the final (post-AQE) physical plans of key queries.

Usage: python tools/explain_plans.py [sf_dir]
"""

from __future__ import annotations

import os
import re
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

KEY_QUERIES = [
    ("market_summary_fused", "one groupBy(symbol) over hash-aggregated candles; ranks on #symbols rows"),
    ("market_summary_joined", "the reference's five aggregates and four joins, for comparison"),
    ("clean_candles_1m", "dirty table (materialised) -> coerce -> one dedup exchange -> filter -> features"),
    ("stratified_sample_5_1m", "partial WindowGroupLimit before the exchange"),
    ("trailing_60s_count", "rows shuffled once, no join (one range at this size: a range frame by key)"),
    ("quality_report_1m", "counts of the raw rows ride on the de-duplicating aggregate: one scan, one shuffle of rows"),
    ("dedup_by_candle_key_1m", "WindowGroupLimit below the only exchange"),
    ("kline_decode", "one parse of a payload"),
    ("duplicate_mask", "first places by a hash aggregate, joined to the rows"),
    ("inject_missing", "exact pick: the cut is a literal, the plan is a projection"),
]


def main() -> None:
    from pyspark.sql import SparkSession

    from candlewick.plans.catalog import QUERIES
    from candlewick.session import ensure_test_checkpoint_dir

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_test_checkpoint_dir(spark, tempfile.mkdtemp(prefix="plans-", dir="/tmp"))
    out = [
        "# Physical plans of key queries",
        "",
        f"Generated by `tools/explain_plans.py` on `{sf}` (local[8], AQE on, final plans after execution).",
        "Lineage-cut tables show as `<checkpoint table>`, driver tables as `<sf>/name.parquet`.",
        "",
    ]
    for name, note in KEY_QUERIES:
        df = QUERIES[name](spark, sf)
        df.collect()  # the same query execution, so the plan below is the final one
        plan = df._jdf.queryExecution().executedPlan().toString()
        plan = re.sub(r"file:/[^,\]\s]*/tables/[0-9a-f]+", "<checkpoint table>", plan)
        plan = re.sub(r"file:/root/testdata/[^,\]\s]*/([a-z]+\.parquet)", r"<sf>/\1", plan)
        lines = [ln[:220] for ln in plan.split("+- == Initial Plan ==")[0].splitlines()]
        shuffles = sum(1 for ln in lines if re.search(r"\bShuffleQueryStage\b", ln))
        broadcasts = sum(1 for ln in lines if re.search(r"\bBroadcastQueryStage\b", ln))
        scans = sum(1 for ln in lines if "FileScan" in ln)
        out += [f"## `{name}`", "", f"{note}. Shuffles: {shuffles}, broadcasts: {broadcasts}, scans: {scans}.", "", "```", *lines, "```", ""]
    with open(os.path.join(ROOT, "PLANS.md"), "w") as f:
        f.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
