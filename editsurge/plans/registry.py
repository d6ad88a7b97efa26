"""Query registry: name -> Spark plan builder, and name -> oracle SQL.

Each builder takes (spark, sf_dir) and returns a DataFrame over the whole
driver tables.  Oracle SQL (DuckDB dialect) is given wherever SQL can state
the operator; stateful streaming and iterative operators have none.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Decorator: register a query builder (and its oracle SQL)."""
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def _load_all() -> None:
    # Importing the modules runs their @register decorators.
    from editsurge.plans import (classify_queries, extra_queries, ingest_queries,  # noqa: F401
                                 ops_queries, serving_queries, source_queries, stream_queries,
                                 trend_queries)


def queries() -> dict[str, QueryFn]:
    _load_all()
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    _load_all()
    return dict(ORACLE)
