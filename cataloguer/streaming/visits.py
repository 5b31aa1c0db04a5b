"""File visits as a stream: byte budget and status fold per micro-batch (L3 with F7, H2-H4).

Visits land as files in work order. A micro-batch needs from the batches before it

* the running total of bytes, one row a batch (``totals``);
* the paths they fetched first (``fetched``, with their place and bytes), whose bytes count once.

It admits its visits from that total on, exact at the file that crosses the cap, and
writes per file key what its visits do to the status: the first initial value and the
last result, each with its position. The status of a file is folded from these rows
over all batches: last result by (batch, position), else what the archive held, else
the first initial value. All writes go through ``batchlog``, so a replayed batch changes
nothing.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import rules
from ..operators.budget import admit_by_budget, byte_events
from ..operators.status import capped_outcome
from .batchlog import nullable, read_batches, write_batch


@dataclass
class VisitStream:
    """Settings of one run's stream. ``on_disk`` and ``outcome`` are columns of the visits; ``outcome`` is null where nothing is written.

    Without ``used`` the visits are written without the bytes on disk before each of them.
    """

    base: str
    key: list[str]
    order: list[str]
    cap_bytes: int
    initial_bytes: int = 0
    uncapped: Column | None = None
    size: str = "size_bytes"
    used: bool = True
    done: list[int] = field(default_factory=list)  # micro-batches worked on, replays included

    def _fetched_schema(self, batch: DataFrame) -> str:
        return ", ".join(f"{c} {batch.schema[c].dataType.simpleString()}" for c in dict.fromkeys([*self.key, *self.order])) + ", bytes long"

    def admit(self, batch: DataFrame, batch_id: int) -> None:
        """Work on one micro-batch: budget, outcome, status rows, total."""
        spark = batch.sparkSession
        self.done.append(batch_id)
        totals = read_batches(spark, self.base, "totals", "total long", batch_id)
        last = totals.agg(F.max_by("total", "batch")).first()[0]
        before = self.initial_bytes if last is None else last
        schema = self._fetched_schema(batch)
        seen = read_batches(spark, self.base, "fetched", schema, batch_id).select(*self.key)
        # bytes on disk: first successful visits as they came in, capped ones too (the total is past the cap by then)
        new = byte_events(batch, self.order, self.key, "outcome", "restricted", self.size, "on_disk")
        new = new.withColumn("bytes", F.col(self.size).cast("long")).select(*dict.fromkeys([*self.key, *self.order]), "bytes")
        write_batch(new.join(seen, self.key, "left_anti"), self.base, "fetched", batch_id)
        added = read_batches(spark, self.base, "fetched", schema).where(F.col("batch") == batch_id)
        write_batch(added.agg((F.coalesce(F.sum("bytes"), F.lit(0)) + before).alias("total")), self.base, "totals", batch_id)
        out = admit_by_budget(batch, self.order, self.key, self.cap_bytes, before, status="outcome", size=self.size,
                              uncapped=self.uncapped, events=added.withColumn(self.size, F.col("bytes")), used=self.used)
        out = out.withColumn("outcome", capped_outcome(F.col("outcome"), F.col("capped"), F.lit(True)))
        write_batch(out, self.base, "visits", batch_id)
        mine = read_batches(spark, self.base, "visits", out.schema).where(F.col("batch") == batch_id)
        write_batch(status_rows(mine, self.key, self.order), self.base, "statuses", batch_id)

    def start(self, spark: SparkSession, source: str, schema, checkpoint: str, max_files_per_trigger: int | None = 1) -> StreamingQuery:
        """Drain what has landed in ``source``, some files a micro-batch (None: all that is new in one)."""
        reader = spark.readStream.schema(nullable(schema))
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
        stream = reader.parquet(source)
        writer = stream.writeStream.foreachBatch(self.admit).option("checkpointLocation", checkpoint)
        return writer.trigger(availableNow=True).start()


def status_rows(visits: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """Per key: ``first`` (position and initial status) and ``last`` (position and result, null without one).

    Columns of ``order`` that are part of the key are the same in a group: a position leaves them out.
    """
    restricted = F.coalesce(F.col("restricted"), F.lit(False))
    initial = F.when(restricted, F.lit(rules.RESTRICTED)).otherwise(F.lit(rules.SKIPPED))
    result = F.when(~restricted, F.col("outcome"))
    at = [F.col(c) for c in order if c not in key]
    return visits.groupBy(*key).agg(
        F.min(F.struct(*at, initial.alias("_to"))).alias("first"),
        F.max(F.when(result.isNotNull(), F.struct(*at, result.alias("_to")))).alias("last"),
    )


def statuses(spark: SparkSession, base: str, schema, key: list[str], existing: DataFrame | None = None) -> DataFrame:
    """``key`` and ``status`` over all micro-batches; ``existing`` is the archive before them.

    A batch holds one row a key, so the batch alone orders the rows of a key.
    """
    rows = read_batches(spark, base, "statuses", schema)
    folded = rows.groupBy(*key).agg(
        F.min(F.struct("batch", F.col("first._to").alias("_to")))["_to"].alias("_initial"),
        F.max(F.when(F.col("last").isNotNull(), F.struct("batch", F.col("last._to").alias("_to"))))["_to"].alias("_result"),
    )
    if existing is None:
        return folded.select(*key, F.coalesce("_result", "_initial").alias("status"))
    both = existing.select(*key, F.col("status").alias("_old")).join(folded, key, "full")
    return both.select(*key, F.coalesce("_result", "_old", "_initial").alias("status"))
