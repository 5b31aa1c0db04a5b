"""Progress ledger (A6, B3, F9): which (source, project_url) pairs are done.

A missing ledger, or one whose files are not Parquet, is an empty ledger and the
run goes on; any other error (storage, permissions) fails the run. Saving
appends the projects completed by a batch; duplicates are harmless because
readers treat the ledger as a set.
"""

from __future__ import annotations

from datetime import datetime, timezone

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .store import _fs

LEDGER_SCHEMA = "source string, project_url string"


def empty_ledger(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], LEDGER_SCHEMA)


def load_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger as a distinct set; empty when the folder is missing or a file is corrupt."""
    fs, folder, _ = _fs(spark, path)
    if not fs.exists(folder):
        return empty_ledger(spark)
    df = spark.read.schema(LEDGER_SCHEMA).parquet(path)
    try:
        df.count()  # reads every footer
    except (PySparkException, Py4JJavaError) as e:
        if "is not a Parquet file" not in str(e):
            raise
        return empty_ledger(spark)
    return df.dropDuplicates(["source", "project_url"])


def save_completed(completed: DataFrame, path: str, stamp: str | None = None) -> None:
    """Append completed projects (``source, project_url``) with ``saved_at``, the UTC time of the save (ISO 8601)."""
    stamp = stamp or datetime.now(timezone.utc).isoformat(timespec="seconds")
    completed.select("source", "project_url", F.lit(stamp).alias("saved_at")).write.mode("append").parquet(path)


def pending(projects: DataFrame, ledger: DataFrame, source_col: str = "source") -> DataFrame:
    """Projects not yet completed by an earlier run (hash anti join)."""
    led = ledger.select(F.col("source").alias(source_col), "project_url")
    return projects.join(led, [source_col, "project_url"], "left_anti")
