"""The registered queries: one per operator, each with its SQL counterpart where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFunction = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFunction] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query under ``name``; ``sql`` gives the same rows from the plain tables."""

    def keep(function: QueryFunction) -> QueryFunction:
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return keep


def load() -> None:
    """Import every module that registers queries."""
    from registry import aggregations, analysis, compound, leaves, lifecycle, ranking, shaping  # noqa: F401
