"""Archive queries: merge (F5-F10), normalisation (K4, K5), flat export (B2, E3, E4, G8, I1),
ledger (E2, F9, G10), audits (E5, E6), registry (A7, E7), source choice (A9), batches (H5).

Inputs are the fixture views: ``fx_projects`` is the projects table / incoming
project batch, ``fx_*_raw`` the harvested children, ``fx_ledger`` the progress
ledger of an earlier run. Merges replay the re-run case (F10): the earlier run
archived the projects listed in the ledger, then a run with a cleared ledger
brings every row again; existing rows win, new ones get ids after ``max(id)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import rules
from ..functions.normalise import normalise_license, normalise_role
from ..functions.text import file_extension, safe_name
from ..operators import merge as M
from ..operators.ordering import order_by_ranges, range_bounds, with_ordinal
from ..operators.status import fold_file_status
from ..session import scratch_path
from ..sources import ledger as L
from ..sources.store import append_rows, read_rows
from ..sources import tables
from . import sqltext as S
from .registry import RUN_TS, RUN_TS_PREVIOUS, query

PROJECT_KEY = ["repository_id", "project_url"]
PROJECT_REQUIRED = [
    "repository_id", "repository_url", "project_url", "title", "download_date",
    "download_repository_folder", "download_project_folder", "download_method",
]
PROJECT_COLS = [
    "query_string", "repository_id", "repository_url", "project_url", "version", "title",
    "description", "language", "doi", "upload_date", "download_date",
    "download_repository_folder", "download_project_folder", "download_version_folder",
    "download_method",
]
FILE_KEY = ["project_id", "file_name"]
FILE_ORDER = ["ord1", "ord2"]


def fx(spark: SparkSession, d: str, name: str) -> DataFrame:
    return tables.table(spark, d, name)


# ---------------------------------------------------------------- archive tables

def archive_projects(spark: SparkSession, d: str, run_ts: str = RUN_TS) -> DataFrame:
    """``fx_projects`` as the projects table (ids given), with the run's columns."""
    p = fx(spark, d, "fx_projects")
    return p.select(
        "id", "query_string", "repository_id", "repository_url", "project_url", "version", "title",
        "description", "language", "doi", "upload_date", F.lit(run_ts).alias("download_date"),
        "download_repository_folder", "download_project_folder",
        F.when(F.col("version").isNotNull(), safe_name("version")).alias("download_version_folder"),
        "download_method",
    )


def archive_files(spark: SparkSession, d: str, by_project: bool = False) -> DataFrame:
    """Files table: one row per (project, name), status folded over the visits (F5 + F7).

    ``by_project`` deals the visits by project first, so a join on the project needs no second shuffle.
    """
    raw = fx(spark, d, "fx_files_raw")
    if by_project:
        raw = raw.select(*FILE_KEY, *FILE_ORDER, "restricted", "status").repartition("project_id")
    folded = fold_file_status(raw, FILE_KEY, FILE_ORDER)
    return folded.select("project_id", "file_name", file_extension("file_name").alias("file_type"), "status")


def ledger_project_ids(spark: SparkSession, d: str) -> DataFrame:
    p = fx(spark, d, "fx_projects")
    return p.join(fx(spark, d, "fx_ledger"), PROJECT_KEY, "left_semi").select(F.col("id").alias("project_id"))


_ARCHIVE_FILES_SQL = f"""
SELECT project_id, file_name, {S.file_ext('file_name')} AS file_type,
  coalesce(max(CASE WHEN NOT restricted THEN {{'a': ord1, 'b': ord2, 'v': status}} END).v,
           min({{'a': ord1, 'b': ord2, 'v': CASE WHEN restricted THEN 'RESTRICTED' ELSE 'SKIPPED' END}}).v) AS status
FROM fx_files_raw GROUP BY project_id, file_name"""

_LEDGER_IDS_SQL = """
SELECT p.id AS project_id FROM fx_projects p
WHERE EXISTS (SELECT 1 FROM fx_ledger l WHERE l.repository_id = p.repository_id AND l.project_url = p.project_url)"""


def _archive_projects_sql(ts: str = RUN_TS) -> str:
    return f"""
SELECT id, query_string, repository_id, repository_url, project_url, version, title, description, language,
  doi, upload_date, '{ts}' AS download_date, download_repository_folder, download_project_folder,
  CASE WHEN version IS NULL THEN NULL ELSE {S.safe_name('version')} END AS download_version_folder,
  download_method
FROM fx_projects"""


# ---------------------------------------------------------------- projects_full

def children_strings(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Keywords / persons / licences per project as ``' | '``-joined sorted distinct strings.

    Dedup (the child tables' natural keys) and string aggregation are one
    aggregate per child table: ``collect_set`` merges map-side, so raw children
    are never joined to projects (that would multiply rows).
    """

    def agg(df: DataFrame, value, name: str) -> DataFrame:
        return df.groupBy("project_id").agg(F.array_join(F.array_sort(F.collect_set(value)), " | ").alias(name))

    kw = agg(M.clean_keywords(fx(spark, d, "fx_keywords_raw")), F.col("keyword"), "keywords")
    pr = agg(M.clean_persons(fx(spark, d, "fx_persons_raw")),
             F.concat(F.col("name"), F.lit(" ("), F.col("role"), F.lit(")")), "persons")
    li = agg(M.clean_licenses(fx(spark, d, "fx_licenses_raw")), F.col("license"), "licenses")
    return kw, pr, li


def projects_full_df(projects: DataFrame, files: DataFrame, kw: DataFrame, pr: DataFrame,
                     li: DataFrame, bounds: list | None = None) -> DataFrame:
    """Flat export: projects LEFT JOIN files, plus the three child strings.

    With ``bounds`` (of the ids' ranges) the order takes one pass over the joined rows; without, Spark
    first runs the joins once more to sample them.
    """
    p = projects.withColumnRenamed("id", "project_id")
    one_per_project = p.join(kw, "project_id", "left").join(pr, "project_id", "left").join(li, "project_id", "left")
    out = one_per_project.join(files, "project_id", "left")
    cols = [
        "project_id", "repository_id", "repository_url", "project_url", "title", "description", "language",
        "doi", "upload_date", "download_date", "download_method", "download_repository_folder",
        "download_project_folder", "download_version_folder", "version", "query_string", "file_name",
        "file_type", "status", "keywords", "persons", "licenses",
    ]
    order = [F.col("project_id").asc(), F.col("file_name").asc_nulls_first()]
    out = out.select(*cols)
    return out.orderBy(*order) if bounds is None else order_by_ranges(out, "project_id", bounds, order)


_CHILD_STRINGS_SQL = f"""
kw AS (SELECT project_id, string_agg(DISTINCT k, ' | ' ORDER BY k) AS keywords
       FROM (SELECT project_id, {S.strip('keyword')} AS k FROM fx_keywords_raw) t WHERE k <> '' GROUP BY project_id),
pr AS (SELECT project_id, string_agg(DISTINCT s, ' | ' ORDER BY s) AS persons
       FROM (SELECT project_id, {S.strip('name')} AS n, {S.strip('name')} || ' (' || {S.role('role')} || ')' AS s
             FROM fx_persons_raw) t WHERE n <> '' GROUP BY project_id),
li AS (SELECT project_id, string_agg(DISTINCT l, ' | ' ORDER BY l) AS licenses
       FROM (SELECT project_id, {S.strip('license')} AS s, {S.license(S.strip('license'))} AS l
             FROM fx_licenses_raw) t WHERE s <> '' GROUP BY project_id)"""


@query("projects_full", oracle=f"""
WITH f AS ({_ARCHIVE_FILES_SQL}),
p AS ({_archive_projects_sql()}),
{_CHILD_STRINGS_SQL}
SELECT p.id AS project_id, p.repository_id, p.repository_url, p.project_url, p.title, p.description,
  p.language, p.doi, p.upload_date, p.download_date, p.download_method, p.download_repository_folder,
  p.download_project_folder, p.download_version_folder, p.version, p.query_string,
  f.file_name, f.file_type, f.status, kw.keywords, pr.persons, li.licenses
FROM p LEFT JOIN f ON f.project_id = p.id
LEFT JOIN kw ON kw.project_id = p.id LEFT JOIN pr ON pr.project_id = p.id LEFT JOIN li ON li.project_id = p.id
ORDER BY p.id, f.file_name NULLS FIRST""")
def projects_full(spark: SparkSession, d: str) -> DataFrame:
    kw, pr, li = children_strings(spark, d)
    # a project has a row for each file, or one
    ids = fx(spark, d, "fx_projects").select("id").unionAll(fx(spark, d, "fx_files_raw").select("project_id"))
    bounds = range_bounds(ids, "id", tables.child_tasks(spark, d))
    return projects_full_df(archive_projects(spark, d), archive_files(spark, d, by_project=True), kw, pr, li, bounds)


# ---------------------------------------------------------------- merges

def merge_oracle(b1: str, b2: str, key: list[str], order: list[str], payload: list[str], out: list[str]) -> str:
    """Oracle text of ``merge_into(merge_into(None, b1), b2)`` written with window functions."""
    order_only = [c for c in order if c not in key]
    tie = ", ".join(f"{c} NULLS FIRST" for c in order_only + payload) or ", ".join(key)
    idord = ", ".join(f"{c} NULLS FIRST" for c in dict.fromkeys(order + key))
    k = ", ".join(key)
    cond = " AND ".join(f"a1.{c} = n.{c}" for c in key)
    cols = ", ".join(out)
    return f"""
WITH b1 AS ({b1}), b2 AS ({b2}),
f1 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {k} ORDER BY {tie}) AS _rn FROM b1) t WHERE _rn = 1),
a1 AS (SELECT CAST(row_number() OVER (ORDER BY {idord}) AS BIGINT) AS id, {cols} FROM f1),
f2 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {k} ORDER BY {tie}) AS _rn FROM b2) t WHERE _rn = 1),
n2 AS (SELECT * FROM f2 n WHERE NOT EXISTS (SELECT 1 FROM a1 WHERE {cond})),
a2 AS (SELECT CAST((SELECT coalesce(max(id), 0) FROM a1) + row_number() OVER (ORDER BY {idord}) AS BIGINT) AS id,
       {cols} FROM n2)
SELECT id, {cols} FROM a1 UNION ALL SELECT id, {cols} FROM a2"""


def _project_batch(df: DataFrame, ts: str) -> DataFrame:
    cols = [
        F.col("id").alias("seq"), "query_string", "repository_id", "repository_url", "project_url", "version",
        "title", "description", "language", "doi", "upload_date", F.lit(ts).alias("download_date"),
        "download_repository_folder", "download_project_folder",
        F.when(F.col("version").isNotNull(), safe_name("version")).alias("download_version_folder"),
        "download_method",
    ]
    return M.drop_not_null_violations(df.select(*cols), PROJECT_REQUIRED)


def _project_batch_sql(where: str, ts: str) -> str:
    nn = " AND ".join(f"{c} IS NOT NULL" for c in PROJECT_REQUIRED)
    return f"""SELECT * FROM (SELECT id AS seq, query_string, repository_id, repository_url, project_url, version,
  title, description, language, doi, upload_date, '{ts}' AS download_date, download_repository_folder,
  download_project_folder, CASE WHEN version IS NULL THEN NULL ELSE {S.safe_name('version')} END
  AS download_version_folder, download_method FROM fx_projects p WHERE {where}) t WHERE {nn}"""


_IN_LEDGER = ("EXISTS (SELECT 1 FROM fx_ledger l WHERE l.repository_id = p.repository_id "
              "AND l.project_url = p.project_url)")
_PROJECT_PAYLOAD = [c for c in PROJECT_COLS if c not in PROJECT_KEY]
_MERGE_PROJECTS_SQL = merge_oracle(
    _project_batch_sql(_IN_LEDGER, RUN_TS_PREVIOUS), _project_batch_sql("TRUE", RUN_TS),
    PROJECT_KEY, ["seq"], _PROJECT_PAYLOAD, PROJECT_COLS,
)


def merged_projects(spark: SparkSession, d: str) -> DataFrame:
    p = fx(spark, d, "fx_projects")
    earlier = p.join(fx(spark, d, "fx_ledger"), PROJECT_KEY, "left_semi")
    a1 = M.merge_into(None, _project_batch(earlier, RUN_TS_PREVIOUS), PROJECT_KEY, ["seq"], columns=PROJECT_COLS)
    return M.merge_into(a1, _project_batch(p, RUN_TS), PROJECT_KEY, ["seq"], columns=PROJECT_COLS)


@query("merge_projects", oracle=_MERGE_PROJECTS_SQL)
def merge_projects(spark: SparkSession, d: str) -> DataFrame:
    return merged_projects(spark, d)


def _child_merge(spark: SparkSession, d: str, batch: DataFrame, key: list[str], order: list[str],
                 columns: list[str]) -> DataFrame:
    earlier = batch.join(ledger_project_ids(spark, d), "project_id", "left_semi")
    tasks = tables.child_tasks(spark, d)
    a1 = M.merge_into(None, earlier, key, order, columns=columns, tasks=tasks)
    return M.merge_into(a1, batch, key, order, columns=columns, tasks=tasks)


def _child_oracle(batch_sql: str, key: list[str], order: list[str], payload: list[str], out: list[str]) -> str:
    b1 = f"SELECT * FROM ({batch_sql}) c WHERE c.project_id IN ({_LEDGER_IDS_SQL})"
    return merge_oracle(b1, batch_sql, key, order, payload, out)


_FILES_BATCH_SQL = f"SELECT project_id, file_name, ord1, ord2, {S.file_ext('file_name')} AS file_type, status FROM fx_files_raw"
_KEYWORDS_SQL = f"SELECT * FROM (SELECT project_id, {S.strip('keyword')} AS keyword FROM fx_keywords_raw) t WHERE keyword <> ''"
_PERSONS_SQL = (f"SELECT * FROM (SELECT project_id, {S.strip('name')} AS name, {S.role('role')} AS role "
                f"FROM fx_persons_raw) t WHERE name <> ''")
_LICENSES_SQL = (f"SELECT project_id, {S.license('s')} AS license FROM (SELECT project_id, "
                 f"{S.strip('license')} AS s FROM fx_licenses_raw) t WHERE s <> ''")


@query("merge_files", oracle=_child_oracle(_FILES_BATCH_SQL, FILE_KEY, FILE_ORDER, ["file_type", "status"],
                                           ["project_id", "file_name", "file_type", "status"]))
def merge_files(spark: SparkSession, d: str) -> DataFrame:
    raw = fx(spark, d, "fx_files_raw")
    batch = raw.select("project_id", "file_name", "ord1", "ord2",
                       file_extension("file_name").alias("file_type"), "status")
    return _child_merge(spark, d, batch, FILE_KEY, FILE_ORDER, ["project_id", "file_name", "file_type", "status"])


@query("merge_keywords", oracle=_child_oracle(_KEYWORDS_SQL, ["project_id", "keyword"], [], [],
                                              ["project_id", "keyword"]))
def merge_keywords(spark: SparkSession, d: str) -> DataFrame:
    batch = M.clean_keywords(fx(spark, d, "fx_keywords_raw"))
    return _child_merge(spark, d, batch, ["project_id", "keyword"], [], ["project_id", "keyword"])


@query("merge_persons", oracle=_child_oracle(_PERSONS_SQL, ["project_id", "name", "role"], [], [],
                                             ["project_id", "name", "role"]))
def merge_persons(spark: SparkSession, d: str) -> DataFrame:
    batch = M.clean_persons(fx(spark, d, "fx_persons_raw"))
    return _child_merge(spark, d, batch, ["project_id", "name", "role"], [], ["project_id", "name", "role"])


@query("merge_licenses", oracle=_child_oracle(_LICENSES_SQL, ["project_id", "license"], [], [],
                                              ["project_id", "license"]))
def merge_licenses(spark: SparkSession, d: str) -> DataFrame:
    batch = M.clean_licenses(fx(spark, d, "fx_licenses_raw"))
    return _child_merge(spark, d, batch, ["project_id", "license"], [], ["project_id", "license"])


@query("assign_ids", oracle=f"""
WITH led AS (SELECT * FROM fx_projects p WHERE {_IN_LEDGER}),
a1 AS (SELECT repository_id, project_url, CAST(row_number() OVER (ORDER BY id) AS BIGINT) AS new_id FROM led),
n2 AS (SELECT * FROM fx_projects p WHERE NOT ({_IN_LEDGER}))
SELECT repository_id, project_url, new_id FROM a1
UNION ALL
SELECT repository_id, project_url,
  CAST((SELECT coalesce(max(new_id), 0) FROM a1) + row_number() OVER (ORDER BY id) AS BIGINT) AS new_id FROM n2""")
def assign_ids(spark: SparkSession, d: str) -> DataFrame:
    """Surrogate ids: the earlier run's rows get 1..n, new rows continue after max(id)."""
    p = fx(spark, d, "fx_projects").select("id", *PROJECT_KEY)
    led = fx(spark, d, "fx_ledger")
    a1 = with_ordinal(p.join(led, PROJECT_KEY, "left_semi"), [F.col("id")], name="new_id")
    top = M.max_id(a1, "new_id")
    a2 = with_ordinal(p.join(led, PROJECT_KEY, "left_anti"), [F.col("id")], name="new_id", start=top + 1)
    return a1.unionByName(a2).select(*PROJECT_KEY, "new_id")


# ---------------------------------------------------------------- normalisation (K4, K5)

@query("normalise_roles", oracle=f"""
SELECT project_id, name, role AS raw_role, {S.role('role')} AS role FROM fx_persons_raw""")
def normalise_roles(spark: SparkSession, d: str) -> DataFrame:
    raw = fx(spark, d, "fx_persons_raw")
    return raw.select("project_id", "name", F.col("role").alias("raw_role"), normalise_role("role").alias("role"))


@query("normalise_licenses", oracle=f"""
SELECT project_id, license AS raw_license, {S.license('license')} AS license FROM fx_licenses_raw""")
def normalise_licenses(spark: SparkSession, d: str) -> DataFrame:
    raw = fx(spark, d, "fx_licenses_raw")
    return raw.select("project_id", F.col("license").alias("raw_license"),
                      normalise_license("license").alias("license"))


# ---------------------------------------------------------------- audits

def _raw_children(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    """Natural keys of the child tables, with repeats."""
    return {
        "files": fx(spark, d, "fx_files_raw").select(*FILE_KEY),
        "keywords": M.clean_keywords(fx(spark, d, "fx_keywords_raw")),
        "person_role": M.clean_persons(fx(spark, d, "fx_persons_raw")),
        "licenses": M.clean_licenses(fx(spark, d, "fx_licenses_raw")),
    }


def _children(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    raw = _raw_children(spark, d)
    return {"files": archive_files(spark, d)} | {name: raw[name].distinct() for name in ("keywords", "person_role", "licenses")}


_CHILD_TABLES_SQL = f"""
files AS ({_ARCHIVE_FILES_SQL}),
keywords AS (SELECT DISTINCT * FROM ({_KEYWORDS_SQL}) t),
person_role AS (SELECT DISTINCT * FROM ({_PERSONS_SQL}) t),
licenses AS (SELECT DISTINCT * FROM ({_LICENSES_SQL}) t)"""


@query("report_table_counts", oracle=f"""
WITH {_CHILD_TABLES_SQL}
SELECT 'projects' AS table_name, count(*) AS n_rows FROM fx_projects
UNION ALL SELECT 'files', count(*) FROM files
UNION ALL SELECT 'keywords', count(*) FROM keywords
UNION ALL SELECT 'person_role', count(*) FROM person_role
UNION ALL SELECT 'licenses', count(*) FROM licenses""")
def report_table_counts(spark: SparkSession, d: str) -> DataFrame:
    parts = [fx(spark, d, "fx_projects").agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.lit("projects").alias("table_name"), "n_rows")]
    for name, df in _children(spark, d).items():
        parts.append(df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("fk_orphans", oracle=f"""
WITH {_CHILD_TABLES_SQL},
parents AS (SELECT id FROM fx_projects WHERE repository_id = 5),
o AS (
  SELECT 'files' AS table_name, project_id FROM files WHERE project_id NOT IN (SELECT id FROM parents)
  UNION ALL SELECT 'keywords', project_id FROM keywords WHERE project_id NOT IN (SELECT id FROM parents)
  UNION ALL SELECT 'person_role', project_id FROM person_role WHERE project_id NOT IN (SELECT id FROM parents)
  UNION ALL SELECT 'licenses', project_id FROM licenses WHERE project_id NOT IN (SELECT id FROM parents))
SELECT table_name, count(*) AS orphan_rows, count(DISTINCT project_id) AS orphan_projects
FROM o GROUP BY table_name""")
def fk_orphans(spark: SparkSession, d: str) -> DataFrame:
    """Foreign-key audit of the four child tables against a Dataverse-only projects table.

    Raw rows are dealt by the child's natural key to tasks that follow the input's size and
    made distinct there, so no task's memory grows with the input; from then on a project is one row.
    """
    parents = fx(spark, d, "fx_projects").where(F.col("repository_id") == 5).select("id")
    raw, tasks = _raw_children(spark, d), tables.child_tasks(spark, d)
    out = None
    for name, child in raw.items():
        per_project = child.repartition(tasks, *child.columns).distinct().groupBy("project_id").agg(F.count(F.lit(1)).alias("n"))
        o = M.orphans(per_project, parents).select(F.lit(name).alias("table_name"), "project_id", "n")
        out = o if out is None else out.unionByName(o)
    return out.groupBy("table_name").agg(
        F.sum("n").alias("orphan_rows"), F.count("project_id").alias("orphan_projects")
    )


@query("file_project_ids", oracle=f"""
WITH mp AS ({_MERGE_PROJECTS_SQL}), f AS ({_ARCHIVE_FILES_SQL})
SELECT mp.id AS project_id, p.project_url, f.file_name, f.file_type, f.status
FROM f JOIN fx_projects p ON p.id = f.project_id
JOIN mp ON mp.repository_id = p.repository_id AND mp.project_url = p.project_url""")
def file_project_ids(spark: SparkSession, d: str) -> DataFrame:
    """Children carry the incoming project; resolve it to the archive id by natural key."""
    incoming = fx(spark, d, "fx_projects").select(F.col("id").alias("project_id"), *PROJECT_KEY)
    archive = merged_projects(spark, d).select(F.col("id").alias("archive_id"), *PROJECT_KEY)
    files = archive_files(spark, d).join(incoming, "project_id").join(archive, PROJECT_KEY)
    return files.select(F.col("archive_id").alias("project_id"), "project_url", "file_name", "file_type", "status")


@query("file_status_fold", oracle=_ARCHIVE_FILES_SQL)
def file_status_fold(spark: SparkSession, d: str) -> DataFrame:
    return archive_files(spark, d)


# ---------------------------------------------------------------- source choice, ledger

def source_of(repository_id) -> F.Column:
    return F.when(repository_id == 16, F.lit("uni_halle")).otherwise(F.lit("dans"))


_FX_PROJECT_COLS = ("id, query_string, repository_id, repository_url, project_url, version, title, description, "
                    "language, doi, upload_date, download_repository_folder, download_project_folder, download_method")


@query("select_source", oracle=f"SELECT {_FX_PROJECT_COLS} FROM fx_projects WHERE repository_id = 16")
def select_source(spark: SparkSession, d: str, source: str = "uni_halle") -> DataFrame:
    """``--source``: keep one source (``dans``, ``uni_halle``) or ``both``.

    The archive's projects lie in a folder per source, so the other source's files are not opened.
    """
    p = fx(spark, d, "fx_projects").withColumn("source", source_of(F.col("repository_id")))
    base = scratch_path(spark, "by-source")
    append_rows(p, base, "projects", partition_by=["source"])
    rows = read_rows(spark, base, "projects")
    return (rows if source == "both" else rows.where(F.col("source") == source)).drop("source")


# The ledger's source is the station for Dataverse and the source name for OAI; the fixture's host
# ("https://h<k>.example") names the station.
LEDGER_SOURCES = [s[2] for s in rules.STATIONS[:4]] + [rules.STATIONS[4][0]]


def with_ledger_source(df: DataFrame) -> DataFrame:
    host = F.substring("project_url", 10, 1).cast("int")
    return df.withColumn("source", F.get(F.array(*[F.lit(x) for x in LEDGER_SOURCES]), host))


def _ledger_source_sql(col: str) -> str:
    whens = " ".join(f"WHEN '{i}' THEN {S.q(x)}" for i, x in enumerate(LEDGER_SOURCES))
    return f"(CASE substr({col}, 10, 1) {whens} END)"


_PROJECTS_SOURCE_SQL = f"(SELECT {_FX_PROJECT_COLS}, {_ledger_source_sql('project_url')} AS source FROM fx_projects)"
_LEDGER_SOURCE_SQL = f"(SELECT {_ledger_source_sql('project_url')} AS source, project_url FROM fx_ledger)"
_DONE_SQL = f"EXISTS (SELECT 1 FROM {_LEDGER_SOURCE_SQL} l WHERE l.source = p.source AND l.project_url = p.project_url)"


def landed_ledger(spark: SparkSession, d: str) -> str:
    """Folder of a saved ledger that holds the fixture's completed projects."""
    path = scratch_path(spark, "ledger")
    L.save_completed(with_ledger_source(fx(spark, d, "fx_ledger")), path)
    return path


@query("anti_completed", oracle=f"SELECT * FROM {_PROJECTS_SOURCE_SQL} p WHERE NOT {_DONE_SQL}")
def anti_completed(spark: SparkSession, d: str) -> DataFrame:
    """Projects that the saved ledger does not list for their source."""
    return L.pending(with_ledger_source(fx(spark, d, "fx_projects")), L.load_ledger(spark, landed_ledger(spark, d)))


@query("semi_completed", oracle=f"SELECT source, count(*) AS n_skipped FROM {_PROJECTS_SOURCE_SQL} p WHERE {_DONE_SQL} GROUP BY source")
def semi_completed(spark: SparkSession, d: str) -> DataFrame:
    ledger = L.load_ledger(spark, landed_ledger(spark, d))
    done = with_ledger_source(fx(spark, d, "fx_projects")).join(ledger, ["source", "project_url"], "left_semi")
    return done.groupBy("source").agg(F.count(F.lit(1)).alias("n_skipped"))


def merged_ledger(spark: SparkSession, d: str) -> DataFrame:
    """The ledger after this run's pending projects were saved to it, and twice at that."""
    path = landed_ledger(spark, d)
    pending = L.pending(with_ledger_source(fx(spark, d, "fx_projects")), L.load_ledger(spark, path))
    pending = pending.select("source", "project_url").checkpoint()  # the ledger grows while it is read otherwise
    for _ in range(2):
        L.save_completed(pending, path)
    return L.load_ledger(spark, path)


_LEDGER_MERGE_SQL = f"""SELECT DISTINCT source, project_url FROM (
  SELECT source, project_url FROM {_LEDGER_SOURCE_SQL} l
  UNION ALL SELECT source, project_url FROM {_PROJECTS_SOURCE_SQL} p) t"""


@query("ledger_merge", oracle=_LEDGER_MERGE_SQL)
def ledger_merge(spark: SparkSession, d: str) -> DataFrame:
    return merged_ledger(spark, d)


@query("report_ledger", oracle=f"""
SELECT source, count(*) AS completed FROM ({_LEDGER_MERGE_SQL}) t GROUP BY source""")
def report_ledger(spark: SparkSession, d: str) -> DataFrame:
    return merged_ledger(spark, d).groupBy("source").agg(F.count(F.lit(1)).alias("completed"))


# ---------------------------------------------------------------- registry

def stations(spark: SparkSession) -> DataFrame:
    rows = [(i, *s) for i, s in enumerate(rules.STATIONS)]
    schema = ("station_ord int, station_key string, station_repository_id int, station_name string, "
              "station_url string, api_base string, folder string, access_method string")
    return spark.createDataFrame(rows, schema)


def _stations_values_sql() -> str:
    def lit(v):
        return "NULL" if v is None else (str(v) if isinstance(v, int) else S.q(v))

    rows = ", ".join("(" + ", ".join(lit(v) for v in (i, *s)) + ")" for i, s in enumerate(rules.STATIONS))
    return (f"(VALUES {rows}) AS st(station_ord, station_key, station_repository_id, station_name, "
            f"station_url, api_base, folder, access_method)")


@query("dim_stations", oracle=f"""
SELECT p.id, st.station_key, st.station_name, st.api_base, st.folder, st.access_method
FROM fx_projects p JOIN {_stations_values_sql()}
  ON st.station_ord = CAST(regexp_extract(p.repository_url, '^https://h([0-9]+)\\.example', 1) AS INTEGER)""")
def dim_stations(spark: SparkSession, d: str) -> DataFrame:
    """Registry attributes per project: the 5-row registry is broadcast (fixed size)."""
    p = fx(spark, d, "fx_projects")
    ordinal = F.regexp_extract("repository_url", r"^https://h([0-9]+)\.example", 1).cast("int")
    st = F.broadcast(stations(spark))
    return p.join(st, ordinal == st["station_ord"]).select(
        "id", "station_key", "station_name", "api_base", "folder", "access_method"
    )


# ---------------------------------------------------------------- progress batches (H5)

@query("progress_batches", oracle=f"""
SELECT id, source, ordinal, CAST((ordinal - 1) // {rules.PROGRESS_SAVE_INTERVAL} AS BIGINT) AS batch_no
FROM (SELECT id, source, CAST(row_number() OVER (PARTITION BY source ORDER BY id) AS BIGINT) AS ordinal
      FROM {_PROJECTS_SOURCE_SQL} p WHERE NOT {_DONE_SQL}) t""")
def progress_batches(spark: SparkSession, d: str) -> DataFrame:
    """Position of each pending project in its station's run and its save batch of 25.

    Each station is a run of its own, the OAI source another. One global
    range-partitioned ordinal over (source, id), minus the first ordinal of the source
    (a tiny per-source aggregate), so no source is a single window task.
    """
    pending = anti_completed(spark, d).select("id", "source")
    g = with_ordinal(pending, [F.col("source"), F.col("id")], name="_g")
    first = g.groupBy("source").agg(F.min("_g").alias("_g0"))
    out = g.join(F.broadcast(first), "source").withColumn("ordinal", (F.col("_g") - F.col("_g0") + 1))
    return out.select("id", "source", "ordinal",
                      F.floor((F.col("ordinal") - 1) / rules.PROGRESS_SAVE_INTERVAL).cast("bigint").alias("batch_no"))
