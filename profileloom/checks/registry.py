"""Registered queries and their oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from profileloom.checks.inputs import oracle

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(sql: str | None = None, name: str | None = None, **views: str):
    """Registers a query under its function's name, with its oracle if there is one."""

    def add(query: Query) -> Query:
        key = name or query.__name__
        QUERIES[key] = query
        if sql is not None:
            ORACLES[key] = oracle(sql, **views)
        return query

    return add
