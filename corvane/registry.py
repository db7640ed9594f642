"""All queries of the engine's own operators, by name, with their SQL oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

FLAGSHIP = "evidence_summary"

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Decorator: the function becomes the query ``name``, with ``sql`` as its oracle."""

    def put(query: Callable[[SparkSession, str], DataFrame]):
        if name in _QUERIES:
            raise ValueError(f"{name} is registered twice")
        _QUERIES[name] = query
        if sql is not None:
            _ORACLES[name] = sql
        return query

    return put


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_ORACLES)


def _load() -> None:
    from corvane import plans  # noqa: F401  registers on import
