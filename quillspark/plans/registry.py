"""Registry of the queries over the driver's tables, each with its DuckDB twin where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a query; a second registration under one name is an error."""

    def add(f: Query) -> Query:
        if name in _QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        _QUERIES[name] = f
        if oracle is not None:
            _ORACLES[name] = oracle
        return f

    return add


def queries() -> dict[str, Query]:
    from quillspark.plans import catalog  # noqa: F401 - registers on import

    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    queries()
    return dict(_ORACLES)
