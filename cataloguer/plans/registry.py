"""Registry of named queries: Spark builder + independent DuckDB oracle text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..sources.tables import with_fixtures

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}
ORACLE_TEXT: dict[str, str] = {}  # before the fixture CTEs are added

# One timestamp per run (K7): passed in, never computed per row, so jobs repeat.
RUN_TS = "2026-01-01T00:00:00+00:00"
RUN_TS_PREVIOUS = "2025-12-01T00:00:00+00:00"


def query(name: str, oracle: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name``."""

    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE_TEXT[name] = oracle
            ORACLES[name] = with_fixtures(oracle)
        return fn

    return deco
