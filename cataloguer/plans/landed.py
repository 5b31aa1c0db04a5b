"""Harvests read from landed files (A1, A3, D8): the page is known from the file's path, and a
broken page stops its harvest as a failed request does."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path, stored
from ..sources import dataverse as DV
from ..sources import oai
from .archive import fx
from .harvest import landed_search_pages
from .registry import query

# Search pages whose body is cut off in the middle.
BROKEN_SEARCH = "station_ord = 2 AND start % 200 = 100"


@query("src_landed_search_pages", oracle=f"""
WITH s AS (SELECT station_ord, keyword_ord, min(start) AS stop FROM fx_hits WHERE {BROKEN_SEARCH} GROUP BY ALL)
SELECT h.station_ord, h.keyword_ord, h.start, h.pos, h.global_id
FROM fx_hits h LEFT JOIN s USING (station_ord, keyword_ord) WHERE s.stop IS NULL OR h.start < s.stop""")
def src_landed_search_pages(spark: SparkSession, d: str) -> DataFrame:
    """Hits of search pages landed as JSON lines, a folder per station and term, up to each term's first broken page."""
    path = scratch_path(spark, "landed-search")
    body = F.when(F.expr(BROKEN_SEARCH), F.expr("substring(payload, 1, 30)")).otherwise(F.col("payload"))
    lines = landed_search_pages(spark, d).select("station_ord", "keyword_ord", "start", body.alias("body"))
    lines.repartition("station_ord", "keyword_ord").write.partitionBy("station_ord", "keyword_ord").json(path)
    hits = DV.search_hits(DV.read_landed_pages(spark, path))
    return hits.select("station_ord", "keyword_ord", "start", "pos", "global_id")


RECORDS_A_PAGE, BROKEN_PAGE, ERROR_PAGE = 10, 13, 17


@query("src_landed_oai_pages", oracle=f"""
SELECT rec // {RECORDS_A_PAGE} AS page_no,
  CAST(row_number() OVER (PARTITION BY rec // {RECORDS_A_PAGE} ORDER BY rec) - 1 AS INTEGER) AS record_index,
  oai_id, deleted, NOT no_dc AS has_dc, CASE WHEN NOT no_dc THEN title END AS title
FROM fx_oai WHERE rec // {RECORDS_A_PAGE} < {BROKEN_PAGE}""")
def src_landed_oai_pages(spark: SparkSession, d: str) -> DataFrame:
    """Records of OAI pages landed as XML files, up to the first page that is broken or an ``<error>``."""
    path = scratch_path(spark, "landed-oai")
    xml = fx(spark, d, "fx_oai_xml").select("rec", "xml", F.expr(f"rec div {RECORDS_A_PAGE}").alias("page_no"))
    # a page holds RECORDS_A_PAGE records, so its list is bounded
    pages = xml.groupBy("page_no").agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("rec", "xml"))), lambda x: x["xml"]), "").alias("records"))
    inner = (
        F.when(F.col("page_no") == ERROR_PAGE, F.lit('<error code="badResumptionToken">gone</error>'))
        .when(F.col("page_no") == BROKEN_PAGE, F.concat(F.lit("<ListRecords><record><header>"), F.col("records"), F.lit("</ListRecords>")))
        .otherwise(F.concat(F.lit("<ListRecords>"), F.col("records"), F.lit("</ListRecords>")))
    )
    text = F.concat(F.lit("<OAI-PMH>"), inner, F.lit("</OAI-PMH>")).alias("value")
    oai.land_pages(pages.select("page_no", text), path)
    landed = stored(oai.read_landed_pages(spark, path), "landed-oai-rows")  # parsed once
    kept = oai.pages_until_error(landed.withColumn("harvest", F.lit("uni_halle")))
    return oai.page_records(kept).select(
        "page_no", "record_index", "oai_id", "deleted", "has_dc", F.get("dc_title", F.lit(0)).alias("title"))
