"""End-to-end harvest runs over the fixtures (M1 adapters + ``archive_run``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import rules
from ..archive_run import run_harvest
from ..operators.dedup import first_hit_per_station
from ..operators.ordering import range_bounds
from ..session import scratch_path
from ..sources import adapters, html, oai, tables
from ..sources import dataverse as DV
from . import sqltext as S
from .archive import fx, projects_full_df
from .harvest import PUBLISHED, RELEASED, dataset_json, landed_search_pages
from .registry import RUN_TS, query


def dataverse_source(spark: SparkSession, d: str) -> adapters.SourceTables:
    """Landed search pages (from ``fx_hits``) and, for each station's first hit, the
    dataset detail the station returned (``fx_dataset_json`` of that DOI)."""
    hits = DV.search_hits(landed_search_pages(spark, d))
    asked = first_hit_per_station(hits, order=["keyword_ord", "start", "item_index"]).select("station_ord", "global_id")
    js = dataset_json(spark, d).select(F.concat(F.lit("doi:10.1/"), F.col("ds")).alias("global_id"), "json")
    details = asked.join(js, "global_id")
    return adapters.dataverse(hits, details)


# Persons and rights of the OAI records (C11, C12), as SQL that both engines read.
CREATOR = "'Author ' || CAST(rec % 50 AS VARCHAR(9))"
CONTRIBUTOR = "CASE WHEN rec % 3 = 0 THEN 'Helper ' || CAST(rec AS VARCHAR(20)) END"
RIGHTS = "CASE rec % 4 WHEN 1 THEN 'http://creativecommons.org/licenses/by/4.0/' WHEN 2 THEN 'on request' END"


def oai_xml(spark: SparkSession, d: str) -> DataFrame:
    """``fx_oai_xml`` with creators, contributors and rights in the records."""
    def element(tag: str, sql: str):
        return F.coalesce(F.concat(F.lit(f"<dc:{tag}>"), F.expr(sql), F.lit(f"</dc:{tag}>")), F.lit(""))

    more = F.concat(element("creator", CREATOR), element("contributor", CONTRIBUTOR), element("rights", RIGHTS), F.lit("</oai_dc:dc>"))
    return fx(spark, d, "fx_oai_xml").select("rec", F.replace("xml", F.lit("</oai_dc:dc>"), more).alias("xml"))


def oai_source(spark: SparkSession, d: str) -> adapters.SourceTables:
    """Landed OAI records (100 per page) and item pages: ``fx_pages`` row ``page_id = rec``
    served at the record's project URL."""
    # a few files hold all records: dealt out, or one task parses them
    xml = oai_xml(spark, d).repartition(tables.child_tasks(spark, d), "rec")
    recs = oai.parse_records(xml.select("rec", "xml", F.expr("rec div 100").alias("page_no"),
                                        (F.col("rec") % 100).alias("record_index")),
                             keep=["rec", "page_no", "record_index"])
    rows = oai.project_rows(recs, keep=["rec"])
    page_url = F.coalesce(F.nullif(F.col("handle"), F.lit("")), F.col("project_url"))
    # one landed page per distinct URL (several records may share a URL; they share its page)
    urls = rows.groupBy(page_url.alias("page_url")).agg(F.min("rec").alias("page_id"))
    # links are extracted on the page rows; only the narrow file rows meet the URLs (html never shuffles)
    files = html.page_files(fx(spark, d, "fx_pages"), keep=["page_id"], placeholder=False)
    files = files.join(urls, "page_id").drop("page_id")
    return adapters.oai_records(recs, page_files=files)


def harvest_run_export(spark: SparkSession, d: str) -> DataFrame:
    """A full run: both adapters -> merged, versioned archive -> flat export."""
    base = scratch_path(spark, "harvest-run")
    res = run_harvest(spark, [dataverse_source(spark, d), oai_source(spark, d)], f"{base}/archive", RUN_TS,
                      ledger_path=f"{base}/ledger")

    def agg(df: DataFrame, value, name: str) -> DataFrame:
        return df.groupBy("project_id").agg(F.array_join(F.array_sort(F.collect_set(value)), " | ").alias(name))

    kw = agg(res.keywords, F.col("keyword"), "keywords")
    pr = agg(res.person_role, F.concat(F.col("name"), F.lit(" ("), F.col("role"), F.lit(")")), "persons")
    li = agg(res.licenses, F.col("license"), "licenses")
    files = res.files.select("project_id", "file_name", "file_type", "status")
    ids = res.projects.select("id").unionAll(res.files.select("project_id"))
    return projects_full_df(res.projects, files, kw, pr, li, range_bounds(ids, "id", tables.child_tasks(spark, d)))


# ---------------------------------------------------------------- adapter outputs (M1), with oracles

_PROJECT_OUT = ["seq", "source", "repository_id", "project_url", "query_string", "repository_url", "version",
                "title", "description", "language", "doi", "upload_date", "download_repository_folder",
                "download_project_folder", "download_version_folder", "download_method", "has_qda"]


def _station_case(col: str, idx: int) -> str:
    whens = " ".join(f"WHEN {i} THEN {'NULL' if s[idx] is None else S.q(s[idx])}" for i, s in enumerate(rules.STATIONS))
    return f"(CASE {col} {whens} END)"


_TERMS = "[" + ", ".join(S.q(t) for t in rules.SEARCH_TERMS) + "]"

_DV_OWNERS = f"""
h AS (SELECT station_ord, keyword_ord, start, global_id,
             CAST(row_number() OVER (PARTITION BY station_ord, keyword_ord, start ORDER BY pos, global_id) - 1
                  AS INTEGER) AS item_index
           FROM fx_hits),
fh AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY station_ord, global_id
                                                   ORDER BY keyword_ord, start, item_index) AS rn
                      FROM h WHERE coalesce(global_id, '') <> '') t WHERE rn = 1),
v AS (SELECT fh.station_ord, fh.keyword_ord, fh.start, fh.item_index, fh.global_id, d.version, d.language,
             d.description, d.n_files, d.n_files = 1 AS has_qda, d.upload_date
      FROM fh JOIN (SELECT *, coalesce(nullif({PUBLISHED}, ''), nullif({RELEASED}, '')) AS upload_date FROM fx_dataset) d
        ON fh.global_id = 'doi:10.1/' || CAST(d.ds AS VARCHAR) WHERE d.n_files > 0),
o AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY global_id ORDER BY station_ord, keyword_ord, start,
                                                  item_index) AS rn FROM v) t WHERE rn = 1),
p AS (SELECT *, CAST(row_number() OVER (ORDER BY station_ord, NOT has_qda, keyword_ord, start, item_index, global_id)
                     AS BIGINT) AS seq,
        'https://doi.org/' || substring(global_id, 5) AS project_url,
        {S.safe_name("replace(replace(global_id, ':', '_'), '/', '_') || '_' || 'Dataset ' || global_id")}
          AS download_project_folder,
        CASE WHEN version IS NULL THEN NULL ELSE {S.safe_name('version')} END AS download_version_folder
      FROM o)"""

_DV_PROJECTS_SQL = f"""
WITH {_DV_OWNERS}
SELECT seq, {_station_case('station_ord', 2)} AS source, 5 AS repository_id, project_url,
  {_TERMS}[keyword_ord] AS query_string, {_station_case('station_ord', 3)} AS repository_url, version,
  'Dataset ' || global_id AS title, description, language, global_id AS doi, upload_date,
  'DANS' AS download_repository_folder, download_project_folder, download_version_folder,
  'API-CALL' AS download_method, has_qda
FROM p"""

_DV_FILES_SQL = f"""
WITH {_DV_OWNERS},
f AS (SELECT 1 AS n_files, 0 AS file_index, CAST(1 AS BIGINT) AS file_id, 'a.qdpx' AS file_name, 'qdpx' AS file_type,
        CAST(10 AS BIGINT) AS size, true AS restricted
      UNION ALL SELECT 2, 0, 1, 'a.PDF', 'pdf', 10, true
      UNION ALL SELECT 2, 1, 2, 'file_2', '', NULL, false)
SELECT p.seq, 5 AS repository_id, p.project_url, f.file_index, f.file_name, f.file_type,
  {_station_case('p.station_ord', 4)} || '/access/datafile/' || CAST(f.file_id AS VARCHAR) AS file_url, f.size,
  f.restricted, concat_ws('/', 'DANS', p.download_project_folder, p.download_version_folder, f.file_name) AS local_path
FROM p JOIN f ON f.n_files = p.n_files"""


@query("adapter_dataverse_projects", oracle=_DV_PROJECTS_SQL)
def adapter_dataverse_projects(spark: SparkSession, d: str) -> DataFrame:
    """Project rows of the Dataverse adapter over landed search pages and details (M1, C17, I4)."""
    return dataverse_source(spark, d).projects.select(*_PROJECT_OUT)


_OAI_KEPT = "SELECT * FROM fx_oai WHERE NOT deleted AND NOT no_dc"
_OAI_T = f"coalesce(nullif({S.strip('title')}, ''), 'untitled')"
_OAI_IDS = "[x FOR x IN [ident1, ident2, ident3] IF x <> '']"
_OAI_PROJECTS_SQL = f"""
WITH k AS (SELECT *, {_OAI_T} AS t,
             coalesce(list_filter({_OAI_IDS}, lambda x: contains(x, 'doi.org'))[-1],
                      list_filter({_OAI_IDS}, lambda x: NOT contains(x, 'doi.org')
                                  AND NOT contains(x, 'opendata.uni-halle.de/handle') AND starts_with(x, 'http'))[1])
               AS doi_v,
             list_filter({_OAI_IDS}, lambda x: NOT contains(x, 'doi.org')
                         AND contains(x, 'opendata.uni-halle.de/handle'))[-1] AS handle_v
           FROM ({_OAI_KEPT}) x),
q AS (SELECT * FROM k WHERE {S.contains_any(f"lower(t || ' ' || {S.strip('description')} || ' ' || {S.strip('subject')} || ' ' || '')", rules.QDA_HINTS)})
SELECT CAST(row_number() OVER (ORDER BY rec // 100, rec % 100) AS BIGINT) AS seq, 'uni_halle' AS source,
  16 AS repository_id, coalesce(handle_v, doi_v, oai_id) AS project_url, '{rules.OAI_QUERY_STRING}' AS query_string,
  '{rules.STATIONS[4][3]}' AS repository_url, CAST(NULL AS VARCHAR) AS version, t AS title,
  nullif({S.strip('description')}, '') AS description, CAST(NULL AS VARCHAR) AS language, doi_v AS doi,
  CAST(NULL AS VARCHAR) AS upload_date, 'opendata' AS download_repository_folder,
  {S.safe_name("replace(regexp_extract(oai_id, '[^:]*$'), '/', '_') || '_' || t")} AS download_project_folder,
  CAST(NULL AS VARCHAR) AS download_version_folder, 'SCRAPING' AS download_method, CAST(NULL AS BOOLEAN) AS has_qda
FROM q"""


@query("adapter_oai_projects", oracle=_OAI_PROJECTS_SQL)
def adapter_oai_projects(spark: SparkSession, d: str) -> DataFrame:
    """Project rows of the OAI adapter: kept, hint-filtered records in harvest order."""
    return oai_source(spark, d).projects.select(*_PROJECT_OUT)


@query("adapter_dataverse_files", oracle=_DV_FILES_SQL)
def adapter_dataverse_files(spark: SparkSession, d: str) -> DataFrame:
    """File rows of the Dataverse adapter: per project's owning station, with local paths."""
    return dataverse_source(spark, d).files.select(
        "seq", "repository_id", "project_url", "file_index", "file_name", "file_type", "file_url", "size",
        "restricted", "local_path")


# ---------------------------------------------------------------- the run's flat export, as one SQL

_PAGE_FILES_SQL = f"""
x AS (SELECT page_id, CASE WHEN http_status = 200 THEN regexp_extract_all(html, 'href="(/bitstream/[^"?]+)"', 1)
        ELSE [] END AS links FROM fx_pages),
l AS (SELECT page_id, unnest(links) AS path, unnest(generate_series(1, len(links))) AS i FROM x),
dl AS (SELECT page_id, path, min(i) AS i FROM l GROUP BY page_id, path),
pn AS (SELECT page_id, path, i, split_part(regexp_extract(path, '[^/]*$'), '?', 1) AS file_name FROM dl
       WHERE NOT {S.contains_any("lower(path)", rules.LINK_SKIP_PATTERNS)}),
pf AS (SELECT page_id, file_name, min(i) AS i FROM pn WHERE file_name <> '' GROUP BY page_id, file_name),
pr0 AS (SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY i) - 1 AS INTEGER) AS file_index,
          file_name, {S.file_ext('file_name')} AS file_type FROM pf)"""

_RUN_SQL = f"""
WITH {_DV_OWNERS},
dvp AS (SELECT 0 AS source_ord, seq, 5 AS repository_id, project_url, {_TERMS}[keyword_ord] AS query_string,
          {_station_case('station_ord', 3)} AS repository_url, version, 'Dataset ' || global_id AS title,
          description, language, global_id AS doi, upload_date,
          'DANS' AS download_repository_folder, download_project_folder, download_version_folder,
          'API-CALL' AS download_method, n_files FROM p),
fdef AS (SELECT 1 AS n_files, 0 AS file_index, 'a.qdpx' AS file_name, 'qdpx' AS file_type, true AS restricted
         UNION ALL SELECT 2, 0, 'a.PDF', 'pdf', true UNION ALL SELECT 2, 1, 'file_2', '', false),
dvf AS (SELECT 0 AS source_ord, dvp.seq, dvp.repository_id, dvp.project_url, fdef.file_index, fdef.file_name,
          fdef.file_type, fdef.restricted FROM dvp JOIN fdef ON fdef.n_files = dvp.n_files),
k AS (SELECT *, {_OAI_T} AS t,
        coalesce(list_filter({_OAI_IDS}, lambda x: contains(x, 'doi.org'))[-1],
                 list_filter({_OAI_IDS}, lambda x: NOT contains(x, 'doi.org')
                             AND NOT contains(x, 'opendata.uni-halle.de/handle') AND starts_with(x, 'http'))[1])
          AS doi_v,
        list_filter({_OAI_IDS}, lambda x: NOT contains(x, 'doi.org')
                    AND contains(x, 'opendata.uni-halle.de/handle'))[-1] AS handle_v
      FROM ({_OAI_KEPT}) x0),
kq AS (SELECT *, coalesce(handle_v, doi_v, oai_id) AS purl FROM k),
q AS (SELECT * FROM kq WHERE {S.contains_any(f"lower(t || ' ' || {S.strip('description')} || ' ' || {S.strip('subject')} || ' ' || '')", rules.QDA_HINTS)}),
oaip AS (SELECT 1 AS source_ord, CAST(row_number() OVER (ORDER BY rec // 100, rec % 100) AS BIGINT) AS seq,
           16 AS repository_id, purl AS project_url, '{rules.OAI_QUERY_STRING}' AS query_string,
           '{rules.STATIONS[4][3]}' AS repository_url, CAST(NULL AS VARCHAR) AS version, t AS title,
           nullif({S.strip('description')}, '') AS description, CAST(NULL AS VARCHAR) AS language, doi_v AS doi,
           CAST(NULL AS VARCHAR) AS upload_date, 'opendata' AS download_repository_folder,
           {S.safe_name("replace(regexp_extract(oai_id, '[^:]*$'), '/', '_') || '_' || t")} AS download_project_folder,
           CAST(NULL AS VARCHAR) AS download_version_folder, 'SCRAPING' AS download_method, rec, subject FROM q),
{_PAGE_FILES_SQL},
urls AS (SELECT purl AS page_url, min(rec) AS page_id FROM kq GROUP BY purl),
oaif0 AS (SELECT oaip.seq, oaip.repository_id, oaip.project_url, pr0.file_index, pr0.file_name, pr0.file_type
          FROM oaip JOIN urls ON urls.page_url = oaip.project_url JOIN pr0 ON pr0.page_id = urls.page_id),
oaif AS (SELECT 1 AS source_ord, seq, repository_id, project_url, file_index, file_name, file_type,
           false AS restricted FROM oaif0
         UNION ALL
         SELECT 1, seq, repository_id, project_url, 0, '{rules.PLACEHOLDER_FILE_NAME}', '{rules.PLACEHOLDER_FILE_TYPE}',
           false FROM oaip WHERE NOT EXISTS (SELECT 1 FROM oaif0 WHERE oaif0.seq = oaip.seq)),
allp AS (SELECT source_ord, seq, repository_id, project_url, query_string, repository_url, version, title,
           description, language, doi, upload_date, download_repository_folder, download_project_folder,
           download_version_folder, download_method FROM dvp
         UNION ALL
         SELECT source_ord, seq, repository_id, project_url, query_string, repository_url, version, title,
           description, language, doi, upload_date, download_repository_folder, download_project_folder,
           download_version_folder, download_method FROM oaip),
fa AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY repository_id, project_url ORDER BY source_ord, seq)
                      AS rn FROM allp) t WHERE rn = 1),
proj AS (SELECT CAST(row_number() OVER (ORDER BY source_ord, seq, repository_id, project_url) AS BIGINT) AS id, *
         FROM fa),
allf AS (SELECT * FROM dvf UNION ALL SELECT * FROM oaif),
fj AS (SELECT proj.id AS project_id, allf.* FROM allf
       JOIN proj ON proj.repository_id = allf.repository_id AND proj.project_url = allf.project_url),
files AS (SELECT project_id, file_name,
            min({{'a': source_ord, 'b': seq, 'c': file_index, 'e': file_type}}).e AS file_type,
            min({{'a': source_ord, 'b': seq, 'c': file_index, 'd': file_name,
                 'v': CASE WHEN restricted THEN 'RESTRICTED' ELSE 'SKIPPED' END}}).v AS status
          FROM fj GROUP BY project_id, file_name),
kwall AS (SELECT dvp.repository_id, dvp.project_url, d.keyword AS kw FROM dvp
            JOIN fx_dataset d ON dvp.doi = 'doi:10.1/' || CAST(d.ds AS VARCHAR)
          UNION ALL SELECT dvp.repository_id, dvp.project_url, d.subject FROM dvp
            JOIN fx_dataset d ON dvp.doi = 'doi:10.1/' || CAST(d.ds AS VARCHAR)
          UNION ALL SELECT repository_id, project_url, subject FROM oaip),
kwa AS (SELECT proj.id AS project_id, string_agg(DISTINCT {S.strip('kw')}, ' | ' ORDER BY {S.strip('kw')}) AS keywords
        FROM kwall JOIN proj ON proj.repository_id = kwall.repository_id AND proj.project_url = kwall.project_url
        WHERE {S.strip('kw')} <> '' GROUP BY proj.id),
pall AS (SELECT dvp.repository_id, dvp.project_url, d.author || ' (AUTHOR)' AS p FROM dvp
            JOIN fx_dataset d ON dvp.doi = 'doi:10.1/' || CAST(d.ds AS VARCHAR)
         UNION ALL SELECT repository_id, project_url, {CREATOR} || ' (AUTHOR)' FROM oaip
         UNION ALL SELECT repository_id, project_url, {CONTRIBUTOR} || ' (OTHER)' FROM oaip WHERE {CONTRIBUTOR} IS NOT NULL),
pra AS (SELECT proj.id AS project_id, string_agg(DISTINCT p, ' | ' ORDER BY p) AS persons
        FROM pall JOIN proj ON proj.repository_id = pall.repository_id AND proj.project_url = pall.project_url GROUP BY proj.id),
lall AS (SELECT dvp.repository_id, dvp.project_url, d.license FROM dvp
            JOIN fx_dataset d ON dvp.doi = 'doi:10.1/' || CAST(d.ds AS VARCHAR)
         UNION ALL SELECT repository_id, project_url, {RIGHTS} FROM oaip),
lia AS (SELECT proj.id AS project_id, string_agg(DISTINCT {S.license('license')}, ' | ' ORDER BY {S.license('license')}) AS licenses
        FROM lall JOIN proj ON proj.repository_id = lall.repository_id AND proj.project_url = lall.project_url
        WHERE license IS NOT NULL GROUP BY proj.id)
SELECT proj.id AS project_id, proj.repository_id, proj.repository_url, proj.project_url, proj.title,
  proj.description, proj.language, proj.doi, proj.upload_date, '{RUN_TS}' AS download_date, proj.download_method,
  proj.download_repository_folder, proj.download_project_folder, proj.download_version_folder, proj.version,
  proj.query_string, files.file_name, files.file_type, files.status, kwa.keywords, pra.persons, lia.licenses
FROM proj LEFT JOIN files ON files.project_id = proj.id LEFT JOIN kwa ON kwa.project_id = proj.id
LEFT JOIN pra ON pra.project_id = proj.id LEFT JOIN lia ON lia.project_id = proj.id"""

query("harvest_run_export", oracle=_RUN_SQL)(harvest_run_export)
