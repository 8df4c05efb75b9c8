"""The table of registered queries and the SQL that says the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cellweave.plans.views import with_views

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(key: str, sql: str | None = None, views: str = "") -> Callable[[Query], Query]:
    """Register a query, with its SQL over the named views when there is one."""

    def register(fn: Query) -> Query:
        if key in QUERIES:
            raise ValueError(f"query {key} registered twice")
        QUERIES[key] = fn
        if sql is not None:
            ORACLES[key] = with_views(views.split(), sql)
        return fn

    return register
