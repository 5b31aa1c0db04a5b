"""Incremental harvest with Structured Streaming (L1-L4).

Newly landed payload files (Parquet rows of a harvest batch) are picked up by a
file-source stream; every micro-batch is merged into the versioned archive with
the same insert-or-ignore merge as the batch job (``foreachBatch``). The stream's
checkpoint remembers which files were done, so a restarted run processes only
new files (resume, L2); ``trigger(availableNow=True)`` drains what is there and
stops, like one harvest run.

Why not streaming ``dropDuplicates``: it keeps an arbitrary row of a batch, not
the first by arrival order, and its state grows without bound unless a watermark
drops keys. The archive itself is the "seen" set (L4): a key merged by an earlier
micro-batch wins over any later one, and within a micro-batch the first arrival
wins. Merging a replayed micro-batch again changes nothing (idempotent by key).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.merge import merge_into, new_rows
from ..sources.store import append_bucketed, highest_id, read_buckets, read_current, write_version
from .batchlog import latest, read_batches, write_batch


def merge_stream(spark: SparkSession, source: str, schema: str, archive_base: str, table: str,
                 key: list[str], order: list[str], checkpoint: str, columns: list[str] | None = None,
                 max_files_per_trigger: int | None = None, available_now: bool = True,
                 append_only: bool = True, buckets: int = 16) -> StreamingQuery:
    """Start a stream that merges files landed in ``source`` into ``archive_base/table``.

    ``append_only`` tables get only each micro-batch's new rows appended, in folders by
    key bucket: a micro-batch reads the keys of the buckets it touches.
    Otherwise the merged table is written as a new version.
    """
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    stream = reader.parquet(source)

    merged_batches: set[int] = set()

    def merge_batch(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        merged_batches.add(batch_id)
        if append_only:
            there = read_buckets(spark, archive_base, table, batch, key, buckets)
            added = new_rows(there, batch, key, order, columns=columns, last_id=highest_id(spark, archive_base, table))
            append_bucketed(added, archive_base, table, key, buckets)
        else:
            merged = merge_into(read_current(spark, archive_base, table), batch, key, order, columns=columns)
            write_version(spark, merged, archive_base, table)

    writer = stream.writeStream.foreachBatch(merge_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    query = writer.start()
    query.merged_batches = merged_batches
    return query


def first_of_stream(spark: SparkSession, source: str, schema, base: str, table: str, key: str, order: list[str],
                    checkpoint: str, max_files_per_trigger: int | None = None) -> StreamingQuery:
    """The first row of each ``key`` by ``order``, whatever order rows land in (L4 with late stations).

    Streaming state holds the minimum per key in Spark's state store; a micro-batch
    emits the keys whose minimum it lowered (update mode), and the sink keeps them in a
    folder of the batch. A row that lands late and comes first takes the key over.
    State is one narrow row a key.
    """
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    best = reader.parquet(source).groupBy(key).agg(F.min(F.struct(*order)).alias("first"))

    def keep(changed: DataFrame, batch_id: int) -> None:
        write_batch(changed, base, table, batch_id)

    return best.writeStream.outputMode("update").foreachBatch(keep).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_first(spark: SparkSession, schema, base: str, table: str, key: str, order: list[str]) -> DataFrame:
    """What ``first_of_stream`` holds: ``key`` and the columns of ``order``."""
    fields = spark.createDataFrame([], schema).select(key, F.struct(*order).alias("first")).schema
    rows = read_batches(spark, base, table, fields)
    return latest(rows, [key], F.col("first")).select(key, "value.*")


def run_until_drained(query: StreamingQuery) -> int:
    """Wait until an ``availableNow`` stream has finished; returns the number of micro-batches it merged.

    There is no time limit: a caller that reads the archive must see every landed file.
    """
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
    return len(getattr(query, "merged_batches", ()))
