from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

_queries: dict[str, Query] = {}
_oracles: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register the function under its name; ``sql`` is its ANSI twin, None if SQL cannot say it."""

    def add(build: Query) -> Query:
        _queries[build.__name__] = build
        if sql is not None:
            _oracles[build.__name__] = sql
        return build

    return add


def queries() -> dict[str, Query]:
    return dict(_queries)


def oracles() -> dict[str, str]:
    return dict(_oracles)
