"""All named queries of the library, each with the SQL that states the same result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}
FLAGSHIP = "panel_signals"


def query(name: str, sql: str | None = None) -> Callable:
    """Registers a query and, where SQL can state its result, that SQL."""

    def add(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[name] = run
        if sql:
            ORACLE_SQL[name] = sql
        return run

    return add


def load() -> None:
    """Imports every module that registers queries."""
    from importlib import import_module

    for name in ("research", "relational", "factors", "lake", "securities", "funds", "monitor", "serving", "evaluation", "models"):
        import_module(f"{__package__}.{name}")
