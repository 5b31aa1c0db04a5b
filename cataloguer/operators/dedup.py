"""First-hit dedup across search terms and stations.

The harvester walks stations in order, terms in order, pages and positions in
order. Within a station a DOI belongs to its first hit (even when its detail
then turns out unusable); across stations it belongs to the first station where
the dataset was *valid* (detail present with files). Both are ``min`` over an
ordered struct: partial aggregation, so a DOI that is hit a million times costs
one row per map task in the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ordering import with_ordinal

HIT_ORDER = ["keyword_ord", "start", "pos"]


def first_hit_per_station(hits: DataFrame, doi: str = "global_id", station: str = "station_ord",
                          order: list[str] = HIT_ORDER) -> DataFrame:
    """D1 + F1: drop hits without an id, keep the first hit of each DOI in each station."""
    valid = hits.where(F.coalesce(F.col(doi), F.lit("")) != "")
    first = valid.groupBy(station, doi).agg(F.min(F.struct(*order)).alias("_h"))
    return first.select(station, doi, *[F.col(f"_h.{c}").alias(c) for c in order])


def first_valid_hit(first_hits: DataFrame, details: DataFrame, doi: str = "global_id",
                    station: str = "station_ord", order: list[str] = HIT_ORDER,
                    files_col: str = "n_files", carry: list[str] | None = None) -> DataFrame:
    """E1 + D2 + F2: join each station's first hit with its detail, drop missing or
    file-less datasets, then keep the earliest station per DOI."""
    carry = carry or ["has_qda"]
    d = details.where(F.col(files_col) > 0).select(station, doi, *carry)
    joined = first_hits.join(d, [station, doi], "inner")
    best = joined.groupBy(doi).agg(F.min(F.struct(station, *order, *carry)).alias("_b"))
    return best.select(doi, *[F.col(f"_b.{c}").alias(c) for c in [station, *order, *carry]])


def work_order(projects: DataFrame, qda_col: str = "has_qda", station: str = "station_ord",
               order: list[str] = HIT_ORDER, doi: str = "global_id", name: str = "work_seq") -> DataFrame:
    """I4 + J1: station by station, QDA projects first, then companion-only ones, each in
    discovery order; the position comes from the range-partitioned ordinal."""
    keys = [F.col(station), (~F.col(qda_col)), *[F.col(c) for c in order], F.col(doi)]
    return with_ordinal(projects, keys, name=name)
