"""candlewick: market-candle analytics on Spark DataFrames.

The package is organised by role:

* ``sources``   – readers (CSV, kline JSON, driver-table adapters) and writers
* ``functions`` – ``Column -> Column`` building blocks (safe casts, symbol
  canonicalisation, candle direction, seeded hash picks)
* ``operators`` – ``DataFrame -> DataFrame`` operators (cleaning, profiling,
  sampling, analytics, defect injection, trailing windows)
* ``plans``     – the registry of named queries with their DuckDB oracle SQL
* ``streaming`` – the same ingest and cleaning operators over a file stream
"""

from candlewick.session import cached, configure, cut_lineage, table_scope

__all__ = ["cached", "configure", "cut_lineage", "table_scope"]
