"""OAI records (A3, C11, C13-C16, D3, D4, D8), item pages (A4, C8, C9, D5, F3, F4),
document scans (D4, K2, K5 on ``documents``) and the folder inventory (A5, G12)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import rules
from ..session import scratch_path
from ..functions.normalise import normalise_license, normalise_role
from ..functions.text import py_strip, safe_name
from ..sources import disk, html, oai
from . import sqltext as S
from .archive import fx
from .registry import query
from ..functions.arrays import explode_rows

# ---------------------------------------------------------------- OAI records

def records(spark: SparkSession, d: str) -> DataFrame:
    return oai.parse_records(fx(spark, d, "fx_oai_xml"), keep=["rec"])


_KEPT_OAI = "SELECT * FROM fx_oai WHERE NOT deleted AND NOT no_dc"
_OAI_TITLE = f"coalesce(nullif({S.strip('title')}, ''), 'untitled')"


@query("src_oai_records", oracle="SELECT rec, oai_id, deleted, NOT no_dc AS has_dc FROM fx_oai")
def src_oai_records(spark: SparkSession, d: str) -> DataFrame:
    return records(spark, d).select("rec", "oai_id", "deleted", "has_dc")


@query("oai_fields", oracle=f"""
SELECT rec, oai_id, {_OAI_TITLE} AS title, nullif({S.strip('description')}, '') AS description,
  CAST(NULL AS VARCHAR) AS language, CAST(NULL AS VARCHAR) AS upload_date, subject,
  {S.safe_name(f"replace(regexp_extract(oai_id, '[^:]*$'), '/', '_') || '_' || {_OAI_TITLE}")} AS download_project_folder,
  '{rules.OAI_QUERY_STRING}' AS query_string, 16 AS repository_id, 'opendata' AS download_repository_folder,
  'SCRAPING' AS download_method
FROM ({_KEPT_OAI}) t""")
def oai_fields(spark: SparkSession, d: str) -> DataFrame:
    """Project columns of kept records: first-element values, all-values lists, folder."""
    p = oai.project_rows(records(spark, d), keep=["rec"])
    return p.select("rec", "oai_id", "title", "description", "language", "upload_date",
                    F.array_join("subjects", " | ").alias("subject"), "download_project_folder", "query_string",
                    "repository_id", "download_repository_folder", "download_method")


_IDS = "[x FOR x IN [ident1, ident2, ident3] IF x <> '']"
_OAI_IDS_SQL = f"""
SELECT rec, oai_id, doi, handle, coalesce(handle, doi, oai_id) AS project_url FROM (
  SELECT rec, oai_id,
    coalesce(list_filter({_IDS}, lambda x: contains(x, 'doi.org'))[-1],
             list_filter({_IDS}, lambda x: NOT contains(x, 'doi.org') AND NOT contains(x, 'opendata.uni-halle.de/handle')
                                      AND starts_with(x, 'http'))[1]) AS doi,
    list_filter({_IDS}, lambda x: NOT contains(x, 'doi.org') AND contains(x, 'opendata.uni-halle.de/handle'))[-1] AS handle
  FROM ({_KEPT_OAI}) k) t"""


@query("oai_identifiers", oracle=_OAI_IDS_SQL)
def oai_identifiers(spark: SparkSession, d: str) -> DataFrame:
    """doi / handle fold over the identifier list and the project URL they give."""
    p = oai.project_rows(records(spark, d), keep=["rec"])
    return p.select("rec", "oai_id", "doi", "handle", "project_url")


@query("oai_hint_filter", oracle=f"""
WITH ids AS ({_OAI_IDS_SQL})
SELECT k.rec, {_OAI_TITLE} AS title, ids.project_url FROM ({_KEPT_OAI}) k JOIN ids ON ids.rec = k.rec
WHERE {S.contains_any(f"lower({_OAI_TITLE} || ' ' || {S.strip('description')} || ' ' || {S.strip('subject')} || ' ' || '')",
                      rules.QDA_HINTS)}""")
def oai_hint_filter(spark: SparkSession, d: str) -> DataFrame:
    """Kept records whose text fields hint at qualitative data analysis."""
    p = oai.project_rows(records(spark, d), keep=["rec"])
    return p.where("has_qda_hint").select("rec", "title", "project_url")


@query("record_persons", oracle=f"""
SELECT rec, {S.strip('subject')} AS name, 'AUTHOR' AS raw_role, 'AUTHOR' AS role FROM ({_KEPT_OAI}) k
WHERE {S.strip('subject')} <> ''
UNION ALL
SELECT rec, {S.strip('title')} AS name, 'CONTRIBUTOR' AS raw_role, 'OTHER' AS role FROM ({_KEPT_OAI}) k
WHERE {S.strip('title')} <> ''""")
def record_persons(spark: SparkSession, d: str) -> DataFrame:
    """Creators as AUTHOR, contributors as CONTRIBUTOR (stored as OTHER). The fixture
    records carry no creator/contributor elements, so subjects stand in for creators
    and titles for contributors."""
    k = oai.kept(records(spark, d))
    creators = F.concat(oai.dc_all("creator"), oai.dc_all("subject"))
    contributors = F.concat(oai.dc_all("contributor"), oai.dc_all("title"))
    tagged = F.concat(
        F.transform(creators, lambda n: F.struct(n.alias("name"), F.lit("AUTHOR").alias("raw_role"))),
        F.transform(contributors, lambda n: F.struct(n.alias("name"), F.lit("CONTRIBUTOR").alias("raw_role"))),
    )
    x = explode_rows(k, tagged, ["rec"], "p")
    return x.select("rec", "p.name", "p.raw_role", normalise_role("p.raw_role").alias("role"))


@query("pages_until_error", oracle="""
WITH r AS (SELECT rec, rec // 100 AS page_no, rec % 700 = 699 AS bad FROM fx_oai)
SELECT rec, page_no FROM r WHERE page_no < coalesce((SELECT min(page_no) FROM r WHERE bad), 9223372036854775807)""")
def pages_until_error(spark: SparkSession, d: str) -> DataFrame:
    """Records of the OAI pages before the first ``<error>`` page (page = rec div 100;
    a page holding a record with rec % 700 = 699 is an error page)."""
    x = fx(spark, d, "fx_oai_xml").select(
        "rec", F.expr("rec div 100").alias("page_no"),
        F.when(F.col("rec") % 700 == 699, F.lit("badResumptionToken")).alias("error_code"),
        F.lit("uni_halle").alias("harvest"))
    return oai.pages_until_error(x).select("rec", "page_no")


# ---------------------------------------------------------------- item pages

def _links_sql(pages_sql: str) -> str:
    """Oracle text: distinct links per page with their first position."""
    return f"""
x AS (SELECT page_set, page_id, CASE WHEN http_status = 200 THEN regexp_extract_all(html, 'href="(/bitstream/[^"?]+)"', 1)
        ELSE [] END AS links FROM ({pages_sql}) p),
l AS (SELECT page_set, page_id, unnest(links) AS path, unnest(generate_series(1, len(links))) AS i FROM x),
d AS (SELECT page_set, page_id, path, min(i) AS i FROM l GROUP BY page_set, page_id, path)"""


def _files_sql(pages_sql: str, placeholder: bool) -> str:
    skip = S.contains_any("lower(path)", rules.LINK_SKIP_PATTERNS)
    body = f"""
WITH {_links_sql(pages_sql)},
n AS (SELECT page_set, page_id, path, i, split_part(regexp_extract(path, '[^/]*$'), '?', 1) AS file_name
      FROM d WHERE NOT {skip}),
f AS (SELECT page_set, page_id, file_name, arg_min(path, i) AS path, min(i) AS i FROM n WHERE file_name <> ''
      GROUP BY page_set, page_id, file_name),
r AS (SELECT page_set, page_id, CAST(row_number() OVER (PARTITION BY page_set, page_id ORDER BY i) - 1 AS INTEGER)
        AS file_index, file_name, {S.file_ext('file_name')} AS file_type,
        '{html.BASE_URL.rstrip('/')}' || path AS file_url FROM f)"""
    if placeholder:
        return body + f"""
SELECT page_set, page_id, file_index, file_name, file_type, file_url FROM r
UNION ALL
SELECT p.page_set, p.page_id, 0, '{rules.PLACEHOLDER_FILE_NAME}', '{rules.PLACEHOLDER_FILE_TYPE}', NULL
FROM ({pages_sql}) p WHERE NOT EXISTS (SELECT 1 FROM r WHERE r.page_set = p.page_set AND r.page_id = p.page_id)"""
    return body + "\nSELECT page_id, file_index, file_name, file_type, file_url FROM r"


_FX_PAGES = "SELECT 'bitstream' AS page_set, page_id, http_status, html FROM fx_pages"
_ALL_PAGES = _FX_PAGES + " UNION ALL SELECT 'plain' AS page_set, page_id, 200 AS http_status, html FROM pages"


@query("src_html_links", oracle=f"""
WITH {_links_sql(_FX_PAGES)}
SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY i) - 1 AS INTEGER) AS link_index, path FROM d""")
def src_html_links(spark: SparkSession, d: str) -> DataFrame:
    """Distinct bitstream link paths per item page, in page order."""
    p = fx(spark, d, "fx_pages")
    links = html.bitstream_links(F.col("html"), F.col("http_status"))
    return explode_rows(p, links, ["page_id"], "path", pos="link_index")


@query("page_files", oracle=_files_sql(_FX_PAGES, placeholder=False))
def page_files(spark: SparkSession, d: str) -> DataFrame:
    """File rows from item pages: skip filter, name = last path segment, first link per name."""
    out = html.page_files(fx(spark, d, "fx_pages"), keep=["page_id"], placeholder=False)
    return out.select("page_id", "file_index", "file_name", "file_type", "file_url")


@query("page_files_placeholder", oracle=_files_sql(_ALL_PAGES, placeholder=True))
def page_files_placeholder(spark: SparkSession, d: str) -> DataFrame:
    """As ``page_files`` over item pages with and without links; a page without files
    yields one ``no_files_found.txt`` row with no URL (C9)."""
    with_links = fx(spark, d, "fx_pages").select(F.lit("bitstream").alias("page_set"), "page_id", "http_status", "html")
    plain = fx(spark, d, "pages").select(F.lit("plain").alias("page_set"), "page_id",
                                         F.lit(200).alias("http_status"), "html")
    out = html.page_files(with_links.unionByName(plain), keep=["page_set", "page_id"])
    return out.select("page_set", "page_id", "file_index", "file_name", "file_type", "file_url")


# ---------------------------------------------------------------- documents

@query("hint_scan_documents", oracle=f"""
SELECT doc_id, {S.contains_any('lower(text)', rules.QDA_HINTS)} AS has_qda_hint FROM documents""")
def hint_scan_documents(spark: SparkSession, d: str) -> DataFrame:
    """The OAI relevance hint applied to whole document texts: one pass, no UDF."""
    docs = fx(spark, d, "documents")
    return docs.select("doc_id", oai.has_qda_hint(F.lower("text")).alias("has_qda_hint"))


LICENSE_LINE_RE = r"(?m)^[^\n]*[Ll][Ii][Cc][Ee][Nn][^\n]*"


@query("license_lines_documents", oracle=f"""
SELECT doc_id, s AS license_line, {S.license('s')} AS license FROM (
  SELECT doc_id, {S.strip('line')} AS s FROM (
    SELECT doc_id, unnest(regexp_extract_all(text, '{LICENSE_LINE_RE}')) AS line FROM documents) a) b
WHERE s <> ''""")
def license_lines_documents(spark: SparkSession, d: str) -> DataFrame:
    """Lines of each document that mention a licence, normalised like stored licences.

    Only the matching lines are extracted (one regex pass over the whole text);
    other lines are never exploded into rows.
    """
    docs = fx(spark, d, "documents")
    lines = explode_rows(docs, F.regexp_extract_all("text", F.lit(LICENSE_LINE_RE), 0), ["doc_id"], "line")
    s = lines.select("doc_id", py_strip("line").alias("license_line")).where(F.col("license_line") != "")
    return s.select("doc_id", "license_line", normalise_license("license_line").alias("license"))


@query("safe_names", oracle=f"SELECT doc_id, {S.safe_name('text')} AS safe_name FROM documents")
def safe_names(spark: SparkSession, d: str) -> DataFrame:
    """Folder-safe name of each whole document text (K2)."""
    return fx(spark, d, "documents").select("doc_id", safe_name("text").alias("safe_name"))


# ---------------------------------------------------------------- folder inventory

@query("src_disk_usage", oracle="""
SELECT count(DISTINCT page_id % 4) AS n_files, CAST(sum(octet_length(encode(coalesce(html, ''))) + 1) AS BIGINT) AS total_bytes FROM pages""")
def src_disk_usage(spark: SparkSession, d: str) -> DataFrame:
    """Files and bytes of a download folder (the byte budget's starting usage): the item pages, landed in four files."""
    path = scratch_path(spark, "disk-usage")
    pages = spark.read.parquet(f"{d.rstrip('/')}/pages.parquet")
    rows = pages.select((F.col("page_id") % 4).alias("part"), F.coalesce("html", F.lit("")).alias("value"))
    rows.repartition(4, "part").write.partitionBy("part").text(path)
    return disk.disk_usage(spark, path)


@query("report_oai_harvest", oracle=f"""
SELECT count(*) AS n_records,
  count(*) FILTER (WHERE {S.contains_any(f"lower({_OAI_TITLE} || ' ' || {S.strip('description')} || ' ' || {S.strip('subject')} || ' ' || '')", rules.QDA_HINTS)})
    AS n_qda_related
FROM ({_KEPT_OAI}) k""")
def report_oai_harvest(spark: SparkSession, d: str) -> DataFrame:
    """G11 for the OAI source: parsed records (not deleted, with Dublin Core) and the QDA-related ones."""
    p = oai.project_rows(records(spark, d), keep=["rec"])
    return p.agg(F.count(F.lit(1)).alias("n_records"), F.count_if("has_qda_hint").alias("n_qda_related"))
