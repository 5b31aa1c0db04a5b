"""Folder inventory (A5, G12): bytes of all files under a folder, ``.tmp`` files excluded.

Spark's ``binaryFile`` source lists the files in parallel; selecting only
``path`` and ``length`` prunes ``content``, so no file is read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def file_inventory(spark: SparkSession, folder: str) -> DataFrame:
    """``path, length`` of every file below ``folder`` (recursive)."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
            .select("path", "length"))


def disk_usage(spark: SparkSession, folder: str) -> DataFrame:
    """One row: number of files and total bytes, files with suffix ``.tmp`` left out (case-sensitive)."""
    inv = file_inventory(spark, folder).where(~F.col("path").rlike(r"[^/]\.tmp$"))
    return inv.agg(F.count(F.lit(1)).alias("n_files"), F.coalesce(F.sum("length"), F.lit(0)).cast("bigint")
                   .alias("total_bytes"))
