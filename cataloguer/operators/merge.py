"""Insert-or-ignore merge of harvested rows into the archive.

Semantics: a natural key is written once. A row already in the archive wins;
among new rows the first arrival wins; no other column is ever changed. New rows
get surrogate ids ``max(id) + 1, ...`` in arrival order.

Plan shape: first arrival per key is a ``min(struct(order..., payload...))``
aggregate (partial aggregation, so a hot key is combined map-side before the
shuffle); the archive check is a hash ``left_anti`` join on the key; ids come
from the range-partitioned ordinal (``ordering.with_ordinal``), never from a
single-partition window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.normalise import normalise_license, normalise_role
from ..functions.text import py_strip
from .ordering import with_ordinal


def first_arrivals(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """One row per ``key``: the first by ``order`` (remaining columns break ties).

    ``min(struct(order..., payload...))`` is a partial aggregate: each map task
    keeps one row per key before the shuffle, which also blunts hot keys.
    """
    order_only = [c for c in order if c not in key]
    payload = [c for c in df.columns if c not in key and c not in order_only]
    inner = order_only + payload
    if not inner:
        return df.select(*key).dropDuplicates(key)
    packed = F.min(F.struct(*[F.col(c) for c in inner])).alias("_first")
    return df.groupBy(*key).agg(packed).select(*key, *[F.col(f"_first.{c}").alias(c) for c in inner])


def drop_not_null_violations(df: DataFrame, required: list[str]) -> DataFrame:
    """Rows with NULL in a NOT NULL column are silently ignored by insert-or-ignore."""
    return df.dropna(subset=required)


def max_id(archive: DataFrame | None, id_col: str = "id") -> int:
    if archive is None:
        return 0
    v = archive.agg(F.max(id_col)).first()[0]
    return int(v) if v is not None else 0


def new_rows(archive: DataFrame | None, batch: DataFrame, key: list[str], order: list[str],
             id_col: str = "id", columns: list[str] | None = None, last_id: int | None = None,
             tasks: int | None = None) -> DataFrame:
    """Rows ``batch`` adds to ``archive`` under insert-or-ignore on ``key``, with their new ids.

    ``order`` is the arrival order of the batch; it must be total on first
    arrivals (append the key when unsure). The result holds ``id_col`` plus
    ``columns`` (default: the batch's columns that are not ordering helpers).
    ``archive`` may be the part of the archive that can hold the batch's keys; ``last_id``
    is then the largest id of the whole of it. ``tasks`` that follow the batch's size keep the
    memory of one task the same for any size: the batch is dealt by key to so many, and the
    archive check and the ids use the same number.
    """
    cols = columns or [c for c in batch.columns if c not in order or c in key]
    first = first_arrivals(batch if tasks is None else batch.repartition(tasks, *key), key, order)
    if archive is not None:
        first = first.join(archive.select(*key), key, "left_anti")
    start = (max_id(archive, id_col) if last_id is None else last_id) + 1
    id_order = list(dict.fromkeys(order + key))
    new = with_ordinal(first, [F.col(c) for c in id_order], name=id_col, start=start, partitions=tasks)
    return new.select(id_col, *cols)


def merge_into(archive: DataFrame | None, batch: DataFrame, key: list[str], order: list[str],
               id_col: str = "id", columns: list[str] | None = None, tasks: int | None = None) -> DataFrame:
    """Archive after inserting ``batch`` with insert-or-ignore on ``key`` (archive + ``new_rows``)."""
    cols = columns or [c for c in batch.columns if c not in order or c in key]
    new = new_rows(archive, batch, key, order, id_col, cols, tasks=tasks)
    return new if archive is None else archive.select(id_col, *cols).unionByName(new)


# --- child-table preparation (insert_keyword / insert_person / insert_license) ---

# ``keep`` names the columns of the arrival order, which decide the new rows' ids.

def clean_keywords(raw: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Strip Python whitespace, drop blanks."""
    k = py_strip("keyword")
    return raw.select("project_id", *keep, k.alias("keyword")).where(F.col("keyword") != "")


def clean_persons(raw: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Strip names, drop blanks, normalise roles."""
    return (
        raw.select("project_id", *keep, py_strip("name").alias("name"), normalise_role("role").alias("role"))
        .where(F.col("name") != "")
    )


def clean_licenses(raw: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Strip, drop blanks, normalise to a label."""
    s = py_strip("license")
    return (
        raw.select("project_id", *keep, s.alias("_s"))
        .where(F.col("_s") != "")
        .select("project_id", *keep, normalise_license("_s").alias("license"))
    )


def orphans(child: DataFrame, parents: DataFrame, fk: str = "project_id", pk: str = "id") -> DataFrame:
    """Child rows whose parent id does not exist (the foreign-key audit)."""
    return child.join(parents.select(F.col(pk).alias(fk)), fk, "left_anti")


def ledger_union(ledger: DataFrame, completed: DataFrame, key: list[str]) -> DataFrame:
    """Set-add of completed projects to the progress ledger."""
    return ledger.select(*key).unionByName(completed.select(*key)).dropDuplicates(key)
