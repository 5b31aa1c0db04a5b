"""Dataverse harvest queries: search pages (A1), first-hit dedup (D1, D2, E1, F1, F2),
work order (I4, J1), harvest audits (G11, D9) and dataset-detail extraction
(A2, C1-C7, C10-C12, C17, K8)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import rules
from ..operators import dedup
from ..sources import dataverse as DV
from . import sqltext as S
from .archive import fx
from .registry import query
from ..functions.arrays import explode_rows

API_BASE = rules.STATIONS[0][4]


# Dates of the payloads: the search item's publication date, and the detail's release time (C4).
# Both are absent, empty or set, in every combination.
PUBLISHED = "CASE length(global_id) % 3 WHEN 0 THEN '2024-05-0' || CAST(length(global_id) % 9 AS VARCHAR(9)) WHEN 1 THEN '' ELSE NULL END"
RELEASED = "CASE ds % 3 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE '2023-01-31T10:00:00Z' END"


def dataset_json(spark: SparkSession, d: str) -> DataFrame:
    """``fx_dataset_json`` with the release time in the payload."""
    latest = '{"data":{"latestVersion":{'
    set_ = F.coalesce(F.concat(F.lit('"releaseTime":"'), F.expr(RELEASED), F.lit('",')), F.lit(""))
    return fx(spark, d, "fx_dataset_json").select("ds", F.replace("json", F.lit(latest), F.concat(F.lit(latest), set_)).alias("json"))


# ---------------------------------------------------------------- search pages (A1)

def landed_search_pages(spark: SparkSession, d: str) -> DataFrame:
    """Search-API pages as landed JSON text, one per (station, term, start) of ``fx_hits``.

    Items carry the hit's id, its fixture position and a name / landing URL made
    from the id. Pages hold about 20 items, so ``collect_list`` per page is bounded.
    """
    hits = fx(spark, d, "fx_hits")
    totals = hits.groupBy("station_ord", "keyword_ord").agg(F.count(F.lit(1)).alias("total_count"))
    item = F.struct("pos", "global_id", F.concat(F.lit("Dataset "), "global_id").alias("name"),
                    F.concat(F.lit("https://doi.org/"), F.substring("global_id", 5, 1 << 20)).alias("url"),
                    F.expr(PUBLISHED).alias("published_at"))
    pages = hits.groupBy(*DV.LANDING_COLS).agg(F.sort_array(F.collect_list(item)).alias("items"))
    body = F.struct(F.struct("total_count", "items").alias("data"))
    return pages.join(totals, ["station_ord", "keyword_ord"]).select(*DV.LANDING_COLS, F.to_json(body).alias("payload"))


@query("src_dataverse_hits", oracle="SELECT station_ord, keyword_ord, start, pos, global_id FROM fx_hits")
def src_dataverse_hits(spark: SparkSession, d: str) -> DataFrame:
    hits = DV.search_hits(landed_search_pages(spark, d))
    return hits.select("station_ord", "keyword_ord", "start", "pos", "global_id")


# ---------------------------------------------------------------- dedup

_FIRST_HIT_SQL = """SELECT station_ord, global_id, keyword_ord, start, pos FROM (
  SELECT *, row_number() OVER (PARTITION BY station_ord, global_id ORDER BY keyword_ord, start, pos) AS rn
  FROM fx_hits WHERE coalesce(global_id, '') <> '') t WHERE rn = 1"""

_FIRST_GLOBAL_SQL = f"""SELECT global_id, station_ord, keyword_ord, start, pos, has_qda FROM (
  SELECT fh.*, d.has_qda, row_number() OVER (PARTITION BY fh.global_id
         ORDER BY fh.station_ord, fh.keyword_ord, fh.start, fh.pos, d.has_qda) AS rn
  FROM ({_FIRST_HIT_SQL}) fh JOIN fx_details d ON d.station_ord = fh.station_ord AND d.global_id = fh.global_id
  WHERE d.n_files > 0) t WHERE rn = 1"""


def first_hits(spark: SparkSession, d: str) -> DataFrame:
    return dedup.first_hit_per_station(fx(spark, d, "fx_hits"))


def first_global(spark: SparkSession, d: str) -> DataFrame:
    return dedup.first_valid_hit(first_hits(spark, d), fx(spark, d, "fx_details"))


@query("first_hit_station", oracle=_FIRST_HIT_SQL)
def first_hit_station(spark: SparkSession, d: str) -> DataFrame:
    return first_hits(spark, d)


@query("first_hit_global", oracle=_FIRST_GLOBAL_SQL)
def first_hit_global(spark: SparkSession, d: str) -> DataFrame:
    return first_global(spark, d)


@query("work_order", oracle=f"""
SELECT global_id, station_ord, has_qda, keyword_ord, start, pos,
  CAST(row_number() OVER (ORDER BY station_ord, NOT has_qda, keyword_ord, start, pos, global_id) AS BIGINT) AS work_seq
FROM ({_FIRST_GLOBAL_SQL}) g""")
def work_order(spark: SparkSession, d: str) -> DataFrame:
    out = dedup.work_order(first_global(spark, d))
    return out.select("global_id", "station_ord", "has_qda", "keyword_ord", "start", "pos", "work_seq")


@query("report_harvest", oracle=f"""
WITH h AS (SELECT station_ord, count(*) AS n_hits FROM fx_hits WHERE coalesce(global_id, '') <> '' GROUP BY station_ord),
fv AS (SELECT fh.station_ord, count(*) AS n_first,
         count(*) FILTER (WHERE EXISTS (SELECT 1 FROM fx_details d WHERE d.station_ord = fh.station_ord
                                        AND d.global_id = fh.global_id AND d.n_files > 0)) AS n_valid
       FROM ({_FIRST_HIT_SQL}) fh GROUP BY fh.station_ord),
g AS (SELECT station_ord, count(*) AS n_projects, count(*) FILTER (WHERE has_qda) AS n_qda,
         count(*) FILTER (WHERE NOT has_qda) AS n_companion FROM ({_FIRST_GLOBAL_SQL}) x GROUP BY station_ord)
SELECT h.station_ord, h.n_hits, fv.n_first, fv.n_valid, coalesce(g.n_projects, 0) AS n_projects,
  coalesce(g.n_qda, 0) AS n_qda, coalesce(g.n_companion, 0) AS n_companion
FROM h JOIN fv USING (station_ord) LEFT JOIN g USING (station_ord)""")
def report_harvest(spark: SparkSession, d: str) -> DataFrame:
    """Per station: hits with an id, first hits, valid datasets, and projects owned (QDA / companion)."""
    hits = fx(spark, d, "fx_hits").where(F.coalesce(F.col("global_id"), F.lit("")) != "")
    h = hits.groupBy("station_ord").agg(F.count(F.lit(1)).alias("n_hits"))
    valid = fx(spark, d, "fx_details").where(F.col("n_files") > 0).select(
        "station_ord", "global_id", F.lit(True).alias("_ok"))
    fv = (first_hits(spark, d).join(valid, ["station_ord", "global_id"], "left").groupBy("station_ord")
          .agg(F.count(F.lit(1)).alias("n_first"), F.count_if(F.col("_ok").isNotNull()).alias("n_valid")))
    g = first_global(spark, d).groupBy("station_ord").agg(
        F.count(F.lit(1)).alias("n_projects"), F.count_if("has_qda").alias("n_qda"),
        F.count_if(~F.col("has_qda")).alias("n_companion"))
    out = h.join(fv, "station_ord").join(g, "station_ord", "left").fillna(0, ["n_projects", "n_qda", "n_companion"])
    return out.select("station_ord", "n_hits", "n_first", "n_valid", "n_projects", "n_qda", "n_companion")


WITHHELD = "start % 60 = 40"  # pages of the fixture that the completeness audit does not land


@query("harvest_completeness", oracle=f"""
WITH p AS (SELECT station_ord, keyword_ord, start, count(*) OVER (PARTITION BY station_ord, keyword_ord) AS total FROM fx_hits)
SELECT station_ord, keyword_ord, CAST(max(total) AS BIGINT) AS total_count, count(DISTINCT start) AS pages_landed,
  CAST(ceil(max(total) / {rules.PAGE_SIZE}.0) AS BIGINT) AS pages_expected,
  count(DISTINCT start) >= CAST(ceil(max(total) / {rules.PAGE_SIZE}.0) AS BIGINT) AS complete
FROM p WHERE NOT ({WITHHELD}) GROUP BY station_ord, keyword_ord""")
def harvest_completeness(spark: SparkSession, d: str) -> DataFrame:
    """Per (station, term): landed pages against the pages that the payload's own total asks for.

    Every third page of the fixture is withheld, so terms of over two pages are incomplete.
    """
    pages = landed_search_pages(spark, d).where(f"NOT ({WITHHELD})")
    total = F.from_json("payload", DV.SEARCH_PAGE_SCHEMA)["data"]["total_count"]
    out = pages.select(*DV.LANDING_COLS, total.alias("total")).groupBy("station_ord", "keyword_ord").agg(
        F.max("total").alias("total_count"), F.count_distinct("start").alias("pages_landed"))
    expected = F.ceil(F.col("total_count") / F.lit(rules.PAGE_SIZE)).cast("bigint")
    return out.withColumn("pages_expected", expected).withColumn(
        "complete", F.col("pages_landed") >= F.col("pages_expected"))


# ---------------------------------------------------------------- dataset details

def details(spark: SparkSession, d: str) -> DataFrame:
    """Parsed dataset details; ``global_id`` is the request parameter of the landing."""
    raw = dataset_json(spark, d).withColumn("global_id", F.concat(F.lit("doi:10.1/"), F.col("ds")))
    return DV.parse_details(raw, keep=["ds", "global_id"])


@query("src_dataverse_details", oracle="""
SELECT ds, version, n_files, 6 AS n_fields FROM fx_dataset""")
def src_dataverse_details(spark: SparkSession, d: str) -> DataFrame:
    x = details(spark, d)
    return x.select("ds", DV.version().alias("version"), F.size("files").alias("n_files"),
                    F.size("fields").alias("n_fields"))


@query("citation_fields", oracle="SELECT ds, description, keyword AS last_keyword, subject FROM fx_dataset")
def citation_fields(spark: SparkSession, d: str) -> DataFrame:
    """Fields by ``typeName`` (last duplicate wins) and the first description value."""
    x = details(spark, d)
    return x.select(
        "ds", DV.description().alias("description"),
        F.try_variant_get(DV.citation_value("fields", "keyword"), "$[0].keywordValue.value", "string")
        .alias("last_keyword"),
        F.try_variant_get(DV.citation_value("fields", "subject"), "$[0]", "string").alias("subject"),
    )


@query("citation_language", oracle="SELECT ds, language FROM fx_dataset")
def citation_language(spark: SparkSession, d: str) -> DataFrame:
    return details(spark, d).select("ds", DV.language().alias("language"))


@query("dataset_files", oracle=f"""
SELECT ds, 0 AS file_index, CAST(1 AS BIGINT) AS file_id, 'a.qdpx' AS file_name, 'qdpx' AS file_type,
  CAST(10 AS BIGINT) AS file_size, true AS restricted, '{API_BASE}/access/datafile/1' AS file_url
FROM fx_dataset WHERE n_files = 1
UNION ALL
SELECT ds, 0, 1, 'a.PDF', 'pdf', 10, true, '{API_BASE}/access/datafile/1' FROM fx_dataset WHERE n_files = 2
UNION ALL
SELECT ds, 1, 2, 'file_2', '', NULL, false, '{API_BASE}/access/datafile/2' FROM fx_dataset WHERE n_files = 2""")
def dataset_files(spark: SparkSession, d: str) -> DataFrame:
    return DV.dataset_files(details(spark, d), API_BASE, keep=["ds"])


@query("dataset_keywords", oracle="""
SELECT ds, keyword FROM fx_dataset UNION ALL SELECT ds, subject AS keyword FROM fx_dataset""")
def dataset_keywords(spark: SparkSession, d: str) -> DataFrame:
    return explode_rows(details(spark, d), DV.keywords(), ["ds"], "keyword")


@query("dataset_license", oracle="SELECT ds, license FROM fx_dataset WHERE license IS NOT NULL")
def dataset_license(spark: SparkSession, d: str) -> DataFrame:
    x = details(spark, d).select("ds", DV.license_value().alias("license"))
    return x.where(F.col("license").isNotNull())


@query("project_fields", oracle=f"""
SELECT ds, global_id AS doi, version, description, language, coalesce(nullif({PUBLISHED}, ''), nullif({RELEASED}, '')) AS upload_date,
  5 AS repository_id, 'DANS' AS download_repository_folder, 'API-CALL' AS download_method,
  CASE WHEN version IS NULL THEN NULL ELSE {S.safe_name('version')} END AS download_version_folder
FROM fx_dataset WHERE n_files > 0""")
def project_fields(spark: SparkSession, d: str) -> DataFrame:
    """Project columns from a detail with files (D2): version, description, language, dates."""
    x = details(spark, d).where(F.size("files") > 0)
    ver = DV.version()
    upload = DV.upload_date(F.expr(PUBLISHED), F.col("release_time"))
    return x.select(
        "ds", F.col("global_id").alias("doi"), ver.alias("version"), DV.description().alias("description"),
        DV.language().alias("language"), upload.alias("upload_date"), F.lit(5).alias("repository_id"),
        F.lit("DANS").alias("download_repository_folder"), F.lit("API-CALL").alias("download_method"),
        DV.version_folder(ver).alias("download_version_folder"),
    )


@query("project_folder", oracle=f"""
SELECT ds, {S.safe_name("replace(replace(global_id, ':', '_'), '/', '_') || '_' || 'Dataset: ' || CAST(ds AS VARCHAR)")}
  AS download_project_folder,
  CASE WHEN version IS NULL THEN NULL ELSE {S.safe_name('version')} END AS download_version_folder
FROM fx_dataset WHERE n_files > 0""")
def project_folder(spark: SparkSession, d: str) -> DataFrame:
    """Folder names: safe name of ``doi_title`` and of the version (title = the hit's name)."""
    x = details(spark, d).where(F.size("files") > 0)
    title = F.concat(F.lit("Dataset: "), F.col("ds").cast("string"))
    return x.select("ds", DV.project_folder(F.col("global_id"), title).alias("download_project_folder"),
                    DV.version_folder(DV.version()).alias("download_version_folder"))
