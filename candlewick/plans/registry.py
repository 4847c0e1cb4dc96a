"""Named queries over the driver tables, each with its DuckDB oracle SQL.

Every query reads the driver's parquet tables (or candles Spark derives from
them) in full. ``QUERIES[name](spark, sf_dir) -> DataFrame`` and
``ORACLES[name] -> str``. Order-dependent double aggregates are returned as
DECIMAL(38,6) so that both engines agree to the last digit.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.session import configure
from candlewick.sources.adapters import candles_from_events, candles_from_lineitem
from candlewick.sources.files import read_table

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return deco


def as_dec(df: DataFrame, columns: Iterable[str], scale: int = 6) -> DataFrame:
    """Cast order-dependent double results to DECIMAL(38,scale) for comparison."""
    return df.withColumns({c: F.col(c).cast(f"decimal(38,{scale})") for c in columns})


def event_candles(spark: SparkSession, sf_dir: str, interval: str = "1h") -> DataFrame:
    configure(spark)
    return candles_from_events(read_table(spark, sf_dir, "events"), interval)


def lineitem_candles(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    return candles_from_lineitem(read_table(spark, sf_dir, "lineitem"))
