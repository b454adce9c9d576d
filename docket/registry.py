"""Name to query and DuckDB twin, filled by the modules of ``docket.plans``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a query under a unique name, with the SQL that must give the same rows."""

    def put(fn: Query) -> Query:
        if name in _QUERIES:
            raise ValueError(f"query {name} is registered twice")
        _QUERIES[name] = fn
        if oracle is not None:
            _ORACLES[name] = oracle
        return fn

    return put


def queries() -> dict[str, Query]:
    import docket.plans  # noqa: F401  registers on import

    return _QUERIES


def oracles() -> dict[str, str]:
    import docket.plans  # noqa: F401

    return _ORACLES
