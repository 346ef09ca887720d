"""Every registered query with the SQL that must give the same rows.

A query is registered with :func:`query`; its SQL may be left out only where SQL cannot say it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def load_all() -> None:
    from chronotape.plans import (  # noqa: F401
        account_queries,
        audit_queries,
        day_queries,
        market_queries,
        storage_queries,
        stream_queries,
        temporal_queries,
    )
