"""Base tables and fixture views of a data folder, registered as Spark temp views."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from .fixture_sql import VIEWS

BASE_TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]

_registered: dict[int, str] = {}


def register(spark: SparkSession, sf_dir: str) -> None:
    """Register the base tables of ``sf_dir`` and every fixture view (idempotent per folder)."""
    key = id(spark)
    if _registered.get(key) == sf_dir and spark.catalog.tableExists("fx_projects"):
        return
    for t in BASE_TABLES:
        spark.read.parquet(f"{sf_dir.rstrip('/')}/{t}.parquet").createOrReplaceTempView(t)
    for name, sql in VIEWS.items():
        spark.sql(sql).createOrReplaceTempView(name)
    _registered[key] = sf_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    register(spark, sf_dir)
    return spark.table(name)


#: Rows of ``lineitem`` and ``orders`` for each task that holds a share of the child rows in memory.
ROWS_PER_TASK = 250_000


def child_tasks(spark: SparkSession, sf_dir: str) -> int:
    """Number of tasks for the rows of the child views: it follows the tables they read (counts come from the file footers)."""
    rows = table(spark, sf_dir, "lineitem").count() + table(spark, sf_dir, "orders").count()
    return max(spark.sparkContext.defaultParallelism, -(-rows // ROWS_PER_TASK))


def with_fixtures(sql: str) -> str:
    """Prefix ``sql`` with the fixture views it names as CTEs (for DuckDB)."""
    used = [n for n in VIEWS if re.search(rf"\b{n}\b", sql)]
    if not used:
        return sql
    ctes = ",\n".join(f"{n} AS (\n{VIEWS[n].strip()}\n)" for n in used)
    body = sql.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"
