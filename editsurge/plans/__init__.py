"""Registered queries: each is a Spark plan plus its DuckDB oracle SQL."""
