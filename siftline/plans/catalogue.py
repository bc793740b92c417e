"""All queries of the core, by name, with their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        _QUERIES[name] = f
        if sql:
            _SQL[name] = sql
        return f

    return add


def _load() -> None:
    from siftline.plans import q_metrics, q_more, q_tables, q_text, q_vectors  # noqa: F401


def queries() -> dict[str, Query]:
    _load()
    return dict(sorted(_QUERIES.items()))


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(sorted(_SQL.items()))
