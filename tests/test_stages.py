"""The three stages over files, and that they leave nothing behind."""

import csv
import os

import pytest

from candlewick.operators.analytics import market_summary
from candlewick.session import checkpoint_dir
from candlewick.sources import candles_from_events, read_cleaned_csv, read_messy_csv, read_table, write_csv
from candlewick.stages import clean_csv, mess_csv, summarise_csv
from tests.conftest import SF001
from tests.fixtures import write_messy


def tables(spark):
    folder = os.path.join(checkpoint_dir(spark).removeprefix("file:"), "tables")
    return set(os.listdir(folder)) if os.path.isdir(folder) else set()


def test_files_in_files_out(spark, tmp_dir):
    before = tables(spark)
    paths = {name: os.path.join(tmp_dir, name) for name in ("candles", "messy", "cleaned", "report.txt", "sample.csv", "summary.csv")}
    candles = candles_from_events(read_table(spark, SF001, "events"))
    write_csv(candles, paths["candles"])
    rows = mess_csv(spark, paths["candles"], paths["messy"], symbols=None)
    n = candles.count()
    kept = n - max(5, int(n * 0.03))
    assert rows == kept + max(5, int(kept * 0.03)) == read_messy_csv(spark, paths["messy"]).count()
    clean_csv(spark, paths["messy"], paths["cleaned"], paths["report.txt"], paths["sample.csv"])
    summarise_csv(spark, paths["cleaned"], paths["summary.csv"])
    with open(paths["report.txt"]) as f:
        text = f.read()
    assert str(rows) in text
    with open(paths["summary.csv"]) as f:
        summary = list(csv.DictReader(f))
    want = market_summary(read_cleaned_csv(spark, paths["cleaned"])).collect()
    assert [r["symbol"] for r in summary] == [r["symbol"] for r in sorted(want, key=lambda r: r["activity_rank"])]
    assert [int(r["activity_rank"]) for r in summary] == list(range(1, len(summary) + 1))
    with open(paths["sample.csv"]) as f:
        seqs = [int(r["seq"]) for r in csv.DictReader(f)]
    assert len(seqs) > 10 and seqs == sorted(seqs)
    assert tables(spark) == before


def test_options_reach_the_stages(spark, tmp_dir):
    source = write_messy(tmp_dir)
    with open(source, "a") as f:
        f.write("BTCUSDT,1h,2026-06-30T00:00:00+00:00,1\n")
    clean_csv(spark, source, f"{tmp_dir}/all")
    clean_csv(spark, source, f"{tmp_dir}/strict", strict=True, dedup_keys=("symbol", "interval", "open_time"), bad_rows="drop")
    count = lambda name: read_cleaned_csv(spark, f"{tmp_dir}/{name}").count()
    assert count("all") == 10 and count("strict") < count("all")
    with pytest.raises(Exception, match="fields"):
        clean_csv(spark, source, f"{tmp_dir}/none", bad_rows="fail")
    empty = os.path.join(tmp_dir, "empty.csv")
    with open(source) as f, open(empty, "w") as g:
        g.write(f.readline())
    with pytest.raises(ValueError, match="No rows"):
        clean_csv(spark, empty, f"{tmp_dir}/none")
