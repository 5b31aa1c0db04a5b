"""Archive store (B4): append-only tables and versioned tables.

Insert-or-ignore never changes a stored row, so the projects, keywords,
person_role and licenses tables only grow: a merge appends its new rows
(``append_rows``), which costs O(new rows), not O(archive). The files table also
has status updates; Parquet cannot be overwritten while it is being read, so it
is written as a new version folder (``write_version``). The current version is the
highest one that Spark committed (it holds ``_SUCCESS``, written last), so the switch
is that single file: a crash at any point leaves the version before it current. Paths
go through the Hadoop FileSystem API, so the same code runs on HDFS, S3 or ABFS.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def _versions(spark: SparkSession, base: str, table: str) -> dict[int, bool]:
    """Version numbers of a table's folders, and whether each is committed."""
    fs, folder, jvm = _fs(spark, f"{base.rstrip('/')}/{table}")
    if not fs.exists(folder):
        return {}
    out = {}
    for status in fs.listStatus(folder):
        name = status.getPath().getName()
        if name.startswith("v") and name[1:].isdigit():
            out[int(name[1:])] = fs.exists(jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS"))
    return out


def current_version(spark: SparkSession, base: str, table: str) -> int:
    """The highest committed version; 0 when the table has never been written."""
    return max((v for v, done in _versions(spark, base, table).items() if done), default=0)


def version_path(base: str, table: str, version: int) -> str:
    return f"{base.rstrip('/')}/{table}/v{version}"


def write_version(spark: SparkSession, df: DataFrame, base: str, table: str,
                  partition_by: list[str] | None = None) -> int:
    """Write ``df`` as the next version; it becomes current when Spark commits the write.

    ``partition_by`` (e.g. ``["source"]``) lays the version out in folders per
    value, so a filter on that column prunes whole folders at read time.
    """
    nxt = max(_versions(spark, base, table), default=0) + 1  # past folders of writes that did not finish
    w = df.write.mode("errorifexists")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(version_path(base, table, nxt))
    return nxt


def read_current(spark: SparkSession, base: str, table: str, schema: T.StructType | str | None = None) -> DataFrame | None:
    v = current_version(spark, base, table)
    if v == 0:
        return None
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.parquet(version_path(base, table, v))


def append_path(base: str, table: str) -> str:
    return f"{base.rstrip('/')}/{table}/rows"


def append_rows(df: DataFrame, base: str, table: str, partition_by: list[str] | None = None) -> None:
    """Add rows to an append-only table (new part files; existing files are never touched).

    ``partition_by`` lays them out in folders per value; readers that filter on it open only those.
    """
    w = df.write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(append_path(base, table))


BUCKET = "key_bucket"


def bucket_of(key: list[str], buckets: int) -> Column:
    """Bucket folder of a natural key."""
    return F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int")


def append_bucketed(df: DataFrame, base: str, table: str, key: list[str], buckets: int) -> None:
    """Add rows to an append-only table laid out in folders by key bucket; one file a bucket and write."""
    rows = df.withColumn(BUCKET, bucket_of(key, buckets))
    append_rows(rows.repartition(buckets, BUCKET), base, table, [BUCKET])


def read_buckets(spark: SparkSession, base: str, table: str, batch: DataFrame, key: list[str], buckets: int) -> DataFrame | None:
    """Rows of the buckets that the keys of ``batch`` fall into (at most ``buckets`` numbers reach the driver).

    The filter is on the folder column, so Spark lists and opens only those folders: a
    small batch costs what it touches, not the whole archive.
    """
    rows = _stored(spark, base, table)
    if rows is None:
        return None
    touched = sorted(r[0] for r in batch.select(bucket_of(key, buckets)).distinct().collect())
    return rows.where(F.col(BUCKET).isin(touched)).drop(BUCKET)


def highest_id(spark: SparkSession, base: str, table: str, id_col: str = "id") -> int:
    """The largest id of an append-only table (0 without rows); one narrow column is read."""
    rows = read_rows(spark, base, table)
    return 0 if rows is None else (rows.agg(F.max(id_col)).first()[0] or 0)


def read_rows(spark: SparkSession, base: str, table: str) -> DataFrame | None:
    """An append-only table, or None before its first append; the bucket folders are no column of it."""
    rows = _stored(spark, base, table)
    return None if rows is None else rows.drop(BUCKET)


def _stored(spark: SparkSession, base: str, table: str) -> DataFrame | None:
    fs, p, _ = _fs(spark, append_path(base, table))
    if not fs.exists(p):
        return None
    return spark.read.parquet(append_path(base, table))
