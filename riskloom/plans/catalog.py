"""Every registered query with the SQL text that checks it, where SQL can state it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under a name. Without `sql` only its rows can be checked."""

    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def load() -> None:
    """Import the modules that register queries."""
    from . import (  # noqa: F401
        queries_graph,
        queries_kpi,
        queries_learning,
        queries_streaming,
        queries_tables,
    )
