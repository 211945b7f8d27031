"""Registry of named queries: Spark callable + (optional) DuckDB oracle SQL.

Each query takes ``(spark, sf_dir)`` and returns a DataFrame over the
driver tables (or tables Spark derives from them).  ``oracle`` is the
equivalent SQL over the same tables; queries that SQL cannot express are
registered without one and are covered by invariant tests instead.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"duplicate query name {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def load_all() -> None:
    """Import every query module (each registers itself)."""
    from . import (alert_queries, ml_queries, model_queries, monitor_queries, profile_queries, scoring_queries,  # noqa: F401
                   series_queries, stats_queries)


def queries() -> dict[str, Query]:
    load_all()
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    load_all()
    return dict(ORACLES)
