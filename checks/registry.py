"""Collects queries and their expected-result SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from checks.oracle_bindings import with_views

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(views: str = "", sql: str | None = None, extra: dict[str, str] | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name; ``sql`` reads the named views."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = with_views(views, sql, extra)
        return f

    return add
