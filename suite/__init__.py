"""The registered queries: each runs a library operator on the given tables, with SQL to compare."""

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def case(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under ``name``; ``sql`` gives the same rows in plain SQL."""

    def register(query: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = query
        if sql is not None:
            SQL[name] = sql.strip()
        return query

    return register


def load_all() -> None:
    for module in ("sources", "profiling", "checks", "rules", "identity", "monitoring", "hr", "streams"):
        import_module(f"suite.{module}")
