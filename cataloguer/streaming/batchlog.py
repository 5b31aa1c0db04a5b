"""Sink of ``foreachBatch`` whose writes can be repeated: one folder per micro-batch.

A micro-batch writes its rows to ``<base>/<table>/batch=<id>`` and replaces that folder
if it is there, so a batch that Spark replays after a failure leaves what one run of it
leaves. Reading takes the folders of the batches before a given one, which
partition pruning selects. Rows carry their batch, so "last writer wins" is an aggregate
over (batch, position): writes cost O(batch), whatever the archive holds.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.store import _fs


def nullable(schema: T.StructType) -> T.StructType:
    """``schema`` as files hold it: every column and nested field may be null."""
    return T.StructType.fromJson(json.loads(schema.json().replace('"nullable":false', '"nullable":true')))


def write_batch(df: DataFrame, base: str, table: str, batch_id: int) -> None:
    """Replace what micro-batch ``batch_id`` has written to a table."""
    df.write.mode("overwrite").option("compression", "zstd").parquet(f"{base.rstrip('/')}/{table}/batch={batch_id}")


def read_batches(spark: SparkSession, base: str, table: str, schema: T.StructType | str, before: int | None = None) -> DataFrame:
    """Rows of a table with their ``batch``; only batches below ``before`` where that is given. ``schema`` is that of a table without any."""
    path = f"{base.rstrip('/')}/{table}"
    fs, folder, _ = _fs(spark, path)
    if not fs.exists(folder):
        return spark.createDataFrame([], schema).withColumn("batch", F.lit(None).cast("long"))
    rows = spark.read.parquet(path).withColumn("batch", F.col("batch").cast("long"))
    return rows if before is None else rows.where(F.col("batch") < before)


def latest(rows: DataFrame, key: list[str], value: Column) -> DataFrame:
    """``key`` and ``value`` as the last batch that wrote the key left it (a partial aggregate)."""
    return rows.groupBy(*key).agg(F.max_by(value, F.col("batch")).alias("value"))
