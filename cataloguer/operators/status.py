"""File status resolution (F7) and fetch outcome from an attempt log (F8, H6)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import rules


def fold_file_status(visits: DataFrame, key: list[str], order: list[str], restricted: str = "restricted",
                     result: str = "status", existing: DataFrame | None = None) -> DataFrame:
    """Final status per file key from its visits, last writer wins.

    A visit first inserts the row (RESTRICTED if flagged, else SKIPPED) - only the
    first insert counts. A non-restricted visit then writes its result (download
    outcome, or SKIPPED when the byte cap is hit). Restricted visits write nothing.
    ``existing`` (key + ``status``) is the archive before this batch: its status
    is kept unless a visit of the batch writes a result.

    Two partial aggregates (``min``/``max`` of ordered structs), one shuffle. Columns of
    ``order`` that are part of the key are the same in a group and stay out of the structs.
    """
    is_r = F.coalesce(F.col(restricted), F.lit(False))
    initial = F.when(is_r, F.lit(rules.RESTRICTED)).otherwise(F.lit(rules.SKIPPED))
    update = F.when(~is_r, F.col(result))
    ordered = [F.col(c) for c in order if c not in key]
    agg = visits.groupBy(*key).agg(
        F.min(F.struct(*ordered, initial.alias("v"))).getField("v").alias("_initial"),
        F.max(F.when(update.isNotNull(), F.struct(*ordered, update.alias("v")))).getField("v").alias("_update"),
    )
    if existing is not None:
        agg = agg.join(existing.select(*key, F.col("status").alias("_existing")), key, "left")
        status = F.coalesce("_update", "_existing", "_initial")
    else:
        status = F.coalesce("_update", "_initial")
    return agg.select(*key, status.alias("status"))


def visit_outcome(outcome: Column, on_disk: Column, downloadable: Column) -> Column:
    """Result of a visit that is not capped: a file already on disk is SUCCESS without an
    attempt, another one has its outcome in the log, one without URL or path writes nothing."""
    return F.when(downloadable, F.when(F.coalesce(on_disk, F.lit(False)), F.lit(rules.SUCCESS)).otherwise(outcome))


def capped_outcome(outcome: Column, capped: Column, downloadable: Column) -> Column:
    """What a visit writes: a capped one is SKIPPED whether or not the log knows it (it is never
    fetched, so it normally has no log row)."""
    return F.when(downloadable & F.coalesce(capped, F.lit(False)), F.lit(rules.SKIPPED)).otherwise(outcome)


def fetch_outcome(log: DataFrame, file_col: str = "file_id", seq_col: str = "seq",
                  http_col: str = "http_status", other_error_col: str | None = None,
                  max_attempts: int = rules.MAX_ATTEMPTS) -> DataFrame:
    """Outcome per file from its attempts in ``seq`` order.

    401/403 -> RESTRICTED at once; other status < 400 -> SUCCESS; any other HTTP
    status or a transport error (NULL status) is retried; after ``max_attempts``
    failures -> FAILED. A non-HTTP error (``other_error_col``) ends as FAILED at once.

    Only the first ``max_attempts`` attempts of a file matter: ``row_number() <= k``
    is planned by Spark as a per-group limit that runs before the shuffle too
    (WindowGroupLimit), so a file with a third of all attempts still ships at most
    k rows per map task.
    """
    http = F.col(http_col)
    terminal = (
        F.when(http.isin(401, 403), F.lit(rules.RESTRICTED))
        .when(http.isNotNull() & (http < 400), F.lit(rules.SUCCESS))
    )
    if other_error_col:
        terminal = F.when(F.coalesce(F.col(other_error_col), F.lit(False)), F.lit(rules.FAILED)).otherwise(terminal)
    w = Window.partitionBy(file_col).orderBy(F.col(seq_col), http.asc_nulls_first())
    extra = [other_error_col] if other_error_col else []
    first_k = (
        log.select(file_col, seq_col, http_col, *extra)
        .withColumn("_rn", F.row_number().over(w))
        .where(F.col("_rn") <= max_attempts)
        .select(file_col, "_rn", terminal.alias("_t"))
    )
    per_file = first_k.groupBy(file_col).agg(
        F.min(F.when(F.col("_t").isNotNull(), F.struct("_rn", "_t"))).alias("_ft"),
        F.count(F.lit(1)).alias("_n"),
    )
    return per_file.select(
        file_col,
        F.coalesce(F.col("_ft._t"), F.lit(rules.FAILED)).alias("outcome"),
        F.coalesce(F.col("_ft._rn"), F.col("_n")).cast("int").alias("attempts"),
    )
