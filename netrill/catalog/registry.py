"""Registered queries and, where SQL can say the same, their statements."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from netrill.catalog import oracle

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
STATEMENTS: dict[str, str] = {}


def register(name: str, select: str | None = None, **parameters: int) -> Callable[[Query], Query]:
    """Register a query; ``select`` reads the oracle's named steps."""

    def add(build: Query) -> Query:
        QUERIES[name] = build
        if select is not None:
            STATEMENTS[name] = oracle.query(select, **parameters)
        return build

    return add
