"""Where the queries of the recording engine are registered, each with its DuckDB SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return add


def _load() -> None:
    from wearlake import index_queries, queries, stage_queries, video_queries  # noqa: F401  (they register their queries)


def queries() -> dict[str, Query]:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_SQL)


def r6(*names: str) -> list:
    """Rounded to 6 places, so that the order of summation doesn't show."""
    return [F.round(n, 6).alias(n) for n in names]
