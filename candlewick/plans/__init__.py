"""Registry of named queries and their DuckDB oracle SQL."""
