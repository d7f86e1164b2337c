"""Queries over the given tables, one or more per operator, each with the SQL it must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under a name, with the equivalent SQL if there is one."""

    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return add


def load_all() -> None:
    from registry import documents, files, graphs, groups, joins, names, releases, upkeep  # noqa: F401
