"""Reports over the archive (G1-G12, I2, I3, D10), file jobs (K1, K3, K6, G7),
byte budget (H2-H4) and fetch outcome (F8, H6)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import rules
from ..functions.normalise import file_class
from ..functions.text import file_extension, human_size
from ..operators.budget import admit_by_budget, station_gate
from ..operators.merge import first_arrivals
from ..operators.status import capped_outcome, fold_file_status, visit_outcome
from ..operators.status import fetch_outcome as fetch_outcome_op
from ..session import stored
from . import sqltext as S
from .archive import _ARCHIVE_FILES_SQL, _IN_LEDGER, anti_completed, archive_files, fx, stations
from .registry import query

QDA_SQL = S.qda_types_list()


def _is_qda_type(c) -> F.Column:
    return F.lower(c).isin(rules.QDA_EXTENSIONS)


# ---------------------------------------------------------------- project reports

@query("report_by_repository", oracle="""
SELECT repository_id, min(download_repository_folder) AS folder, count(*) AS n_projects
FROM fx_projects GROUP BY repository_id""")
def report_by_repository(spark: SparkSession, d: str) -> DataFrame:
    return fx(spark, d, "fx_projects").groupBy("repository_id").agg(
        F.min("download_repository_folder").alias("folder"), F.count(F.lit(1)).alias("n_projects"))


@query("report_by_folder", oracle="""
SELECT download_repository_folder, count(*) AS n_projects FROM fx_projects GROUP BY download_repository_folder""")
def report_by_folder(spark: SparkSession, d: str) -> DataFrame:
    return fx(spark, d, "fx_projects").groupBy("download_repository_folder").agg(
        F.count(F.lit(1)).alias("n_projects"))


@query("report_run_totals", oracle=f"""
SELECT repo_group, station_key, count(*) AS n_new
FROM (SELECT CASE WHEN p.repository_id = 5 THEN 'DANS' ELSE 'uni_halle' END AS repo_group,
             CASE CAST(regexp_extract(p.repository_url, '^https://h([0-9]+)\\.example', 1) AS INTEGER)
             {' '.join(f"WHEN {i} THEN {S.q(s[0])}" for i, s in enumerate(rules.STATIONS))} END AS station_key
      FROM fx_projects p WHERE NOT ({_IN_LEDGER})) t
GROUP BY ROLLUP (repo_group, station_key)""")
def report_run_totals(spark: SparkSession, d: str) -> DataFrame:
    """New projects of this run per station, per repository group, and overall (NULL = total)."""
    new = anti_completed(spark, d)
    ordinal = F.regexp_extract("repository_url", r"^https://h([0-9]+)\.example", 1).cast("int")
    st = F.broadcast(stations(spark).select("station_ord", "station_key"))
    rows = new.join(st, ordinal == st["station_ord"], "left").select(
        F.when(F.col("repository_id") == 5, "DANS").otherwise("uni_halle").alias("repo_group"), "station_key")
    return rows.rollup("repo_group", "station_key").agg(F.count(F.lit(1)).alias("n_new"))


# ---------------------------------------------------------------- files reports

@query("report_by_status", oracle=f"""
SELECT status, count(*) AS n_files FROM ({_ARCHIVE_FILES_SQL}) f GROUP BY status ORDER BY n_files DESC, status""")
def report_by_status(spark: SparkSession, d: str) -> DataFrame:
    return (archive_files(spark, d).groupBy("status").agg(F.count(F.lit(1)).alias("n_files"))
            .orderBy(F.desc("n_files"), "status"))


@query("report_qda_types", oracle=f"""
SELECT file_type, count(*) AS n_files FROM ({_ARCHIVE_FILES_SQL}) f
WHERE status = 'SUCCESS' AND lower(file_type) IN ({QDA_SQL})
GROUP BY file_type ORDER BY n_files DESC, file_type""")
def report_qda_types(spark: SparkSession, d: str) -> DataFrame:
    f = archive_files(spark, d)
    return (f.where((F.col("status") == rules.SUCCESS) & _is_qda_type(F.col("file_type")))
            .groupBy("file_type").agg(F.count(F.lit(1)).alias("n_files"))
            .orderBy(F.desc("n_files"), "file_type"))


@query("report_success_split", oracle=f"""
SELECT count(*) FILTER (WHERE status = 'SUCCESS') AS total_success,
  count(*) FILTER (WHERE status = 'SUCCESS' AND lower(file_type) IN ({QDA_SQL})) AS qda_success,
  count(*) FILTER (WHERE status = 'SUCCESS') - count(*) FILTER (WHERE status = 'SUCCESS' AND lower(file_type) IN ({QDA_SQL}))
    AS companion_success
FROM ({_ARCHIVE_FILES_SQL}) f""")
def report_success_split(spark: SparkSession, d: str) -> DataFrame:
    """Successful files, QDA ones, and the rest (companion = total - QDA, so unknown types count)."""
    f = archive_files(spark, d)
    ok = F.col("status") == rules.SUCCESS
    out = f.agg(F.count_if(ok).alias("total_success"),
                F.count_if(ok & _is_qda_type(F.col("file_type"))).alias("qda_success"))
    return out.withColumn("companion_success", F.col("total_success") - F.col("qda_success"))


@query("report_top_companion", oracle=f"""
SELECT file_type, count(*) AS n_files FROM ({_ARCHIVE_FILES_SQL}) f
WHERE status = 'SUCCESS' AND lower(file_type) NOT IN ({QDA_SQL})
GROUP BY file_type ORDER BY n_files DESC, file_type LIMIT 10""")
def report_top_companion(spark: SparkSession, d: str) -> DataFrame:
    """Top-10 non-QDA types among successful files (the limit is the report)."""
    f = archive_files(spark, d)
    return (f.where((F.col("status") == rules.SUCCESS) & ~_is_qda_type(F.col("file_type")))
            .groupBy("file_type").agg(F.count(F.lit(1)).alias("n_files"))
            .orderBy(F.desc("n_files"), "file_type").limit(10))


# ---------------------------------------------------------------- file jobs

@query("file_extensions", oracle=f"""
SELECT project_id, file_name, {S.file_ext('file_name')} AS file_type FROM fx_files_raw""")
def file_extensions(spark: SparkSession, d: str) -> DataFrame:
    raw = fx(spark, d, "fx_files_raw")
    return raw.select("project_id", "file_name", file_extension("file_name").alias("file_type"))


@query("classify_files", oracle=f"""
SELECT project_id, file_name, {S.file_ext('file_name')} AS file_type, {S.file_class('file_name')} AS file_class
FROM fx_files_raw""")
def classify_files(spark: SparkSession, d: str) -> DataFrame:
    raw = fx(spark, d, "fx_files_raw")
    return raw.select("project_id", "file_name", file_extension("file_name").alias("file_type"),
                      file_class("file_name").alias("file_class"))


@query("project_file_profile", oracle=f"""
SELECT project_id, count(*) AS n_files,
  count(*) FILTER (WHERE c = 'qda') AS n_qda, count(*) FILTER (WHERE c = 'companion') AS n_companion,
  count(*) FILTER (WHERE c = 'other') AS n_other, count(*) FILTER (WHERE restricted) AS n_restricted,
  bool_or(c = 'qda') AS has_qda
FROM (SELECT project_id, restricted, {S.file_class('file_name')} AS c FROM fx_files_raw) t GROUP BY project_id""")
def project_file_profile(spark: SparkSession, d: str) -> DataFrame:
    """Per project: files by class, restricted count, and whether any QDA file exists."""
    raw = fx(spark, d, "fx_files_raw").select("project_id", "restricted", file_class("file_name").alias("c"))
    c = F.col("c")
    return raw.groupBy("project_id").agg(
        F.count(F.lit(1)).alias("n_files"), F.count_if(c == "qda").alias("n_qda"),
        F.count_if(c == "companion").alias("n_companion"), F.count_if(c == "other").alias("n_other"),
        F.count_if(F.col("restricted")).alias("n_restricted"), F.bool_or(c == "qda").alias("has_qda"),
    )


@query("human_sizes", oracle=f"""
SELECT project_id, file_name, size_bytes, {S.human_size('size_bytes')} AS size_human FROM fx_files_raw""")
def human_sizes(spark: SparkSession, d: str) -> DataFrame:
    raw = fx(spark, d, "fx_files_raw")
    return raw.select("project_id", "file_name", "size_bytes", human_size("size_bytes").alias("size_human"))


# ---------------------------------------------------------------- byte budget (H2-H4)

# The fixture's cap: the original's 50 GiB scaled down so that the sf0.01-sf0.1
# fixtures cross it mid-stream.
FIXTURE_CAP_BYTES = 512 * 1024 ** 2
WORK_ORDER = ["station_ord", "ord1", "ord2", "project_id", "file_name", "status", "size_bytes"]


def _visits(spark: SparkSession, d: str) -> DataFrame:
    raw = fx(spark, d, "fx_files_raw")
    return raw.select((F.col("ord1") % 4).cast("int").alias("station_ord"), "ord1", "ord2", "project_id",
                      "file_name", "restricted", "status", "size_bytes")


_VISITS_SQL = """SELECT CAST(ord1 % 4 AS INTEGER) AS station_ord, ord1, ord2, project_id, file_name, restricted,
  status, size_bytes FROM fx_files_raw"""
_ORDER_SQL = ", ".join(WORK_ORDER)
_EVENTS_SQL = f"""
v AS ({_VISITS_SQL}),
e AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY project_id, file_name ORDER BY {_ORDER_SQL}) AS rn
                     FROM v WHERE status = 'SUCCESS' AND NOT restricted) t WHERE rn = 1),
u AS (SELECT station_ord, ord1, ord2, project_id, file_name, restricted, status, size_bytes,
             0 AS is_event, CAST(0 AS BIGINT) AS bytes FROM v
      UNION ALL
      SELECT station_ord, ord1, ord2, project_id, file_name, restricted, status, size_bytes,
             1 AS is_event, size_bytes AS bytes FROM e),
r AS (SELECT *, CAST(coalesce(sum(bytes) OVER (ORDER BY {_ORDER_SQL}, is_event
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS used_before FROM u)"""


@query("budget_admission", oracle=f"""
WITH {_EVENTS_SQL}
SELECT station_ord, ord1, ord2, project_id, file_name, restricted, size_bytes, used_before,
  CASE WHEN restricted THEN 'RESTRICTED' WHEN used_before >= {FIXTURE_CAP_BYTES} THEN 'SKIPPED' ELSE status END
    AS budget_status
FROM r WHERE is_event = 0""")
def budget_admission(spark: SparkSession, d: str) -> DataFrame:
    out = admit_by_budget(stored(_visits(spark, d), "visits"), WORK_ORDER, key=["project_id", "file_name"],
                          cap_bytes=FIXTURE_CAP_BYTES)
    return out.select("station_ord", "ord1", "ord2", "project_id", "file_name", "restricted", "size_bytes",
                      "used_before", "budget_status")


@query("budget_station_gate", oracle=f"""
WITH {_EVENTS_SQL},
s AS (SELECT station_ord, CAST(sum(size_bytes) AS BIGINT) AS station_bytes FROM e GROUP BY station_ord),
a AS (SELECT DISTINCT station_ord FROM v),
j AS (SELECT a.station_ord, coalesce(s.station_bytes, 0) AS station_bytes FROM a LEFT JOIN s USING (station_ord))
SELECT station_ord, station_bytes,
  CAST(coalesce(sum(station_bytes) OVER (ORDER BY station_ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
       AS BIGINT) AS used_before,
  coalesce(sum(station_bytes) OVER (ORDER BY station_ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
    < {FIXTURE_CAP_BYTES} AS harvested
FROM j""")
def budget_station_gate(spark: SparkSession, d: str) -> DataFrame:
    return station_gate(_visits(spark, d), WORK_ORDER, key=["project_id", "file_name"],
                        cap_bytes=FIXTURE_CAP_BYTES)


# ---------------------------------------------------------------- two runs over one archive

FIRST_CAP_BYTES = FIXTURE_CAP_BYTES // 2
UNCAPPED_STATION = 3
KEY_FILE = ["project_id", "file_name"]


def _two_runs_sql() -> str:
    """Both runs as plain windows over one total order."""

    def used(rows: str, initial: str) -> str:
        return f"""SELECT *, CAST({initial} + coalesce(sum(CASE WHEN first THEN size_bytes ELSE 0 END) OVER (ORDER BY rn
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS used FROM {rows}"""

    def firsts(rows: str, ok: str) -> str:
        return f"""SELECT *, ok AND rn = min(CASE WHEN ok THEN rn END) OVER (PARTITION BY project_id, file_name) AS first
          FROM (SELECT *, ({ok}) AS ok FROM {rows}) t"""

    last = "arg_max(o, rn) FILTER (NOT restricted AND o IS NOT NULL)"
    return f"""
WITH v AS (SELECT *, row_number() OVER (ORDER BY {_ORDER_SQL}) AS rn FROM ({_VISITS_SQL}) t),
a1 AS ({firsts("v", "status = 'SUCCESS' AND NOT restricted")}),
u1 AS ({used("a1", "0")}),
o1 AS (SELECT *, CASE WHEN used >= {FIRST_CAP_BYTES} THEN 'SKIPPED' ELSE status END AS o FROM u1),
s1 AS (SELECT project_id, file_name, coalesce({last}, arg_min(CASE WHEN restricted THEN 'RESTRICTED' ELSE 'SKIPPED' END, rn)) AS status
       FROM o1 GROUP BY ALL),
d AS (SELECT project_id, file_name, true AS there FROM s1 WHERE status = 'SUCCESS'),
i AS (SELECT CAST(coalesce(sum(b), 0) AS BIGINT) AS b FROM (SELECT arg_min(size_bytes, rn) AS b FROM o1
      WHERE o = 'SUCCESS' AND NOT restricted GROUP BY project_id, file_name) t),
v2 AS (SELECT v.*, there, CASE WHEN there THEN 'SUCCESS' WHEN size_bytes % 3 = 0 THEN NULL ELSE status END AS res
       FROM v LEFT JOIN d USING (project_id, file_name)),
a2 AS ({firsts("v2", "coalesce(res = 'SUCCESS', false) AND NOT restricted AND there IS NULL")}),
st AS (SELECT station_ord, CAST(coalesce(sum(size_bytes) FILTER (first), 0) AS BIGINT) AS b FROM a2 GROUP BY 1),
g AS (SELECT station_ord, (SELECT b FROM i) + coalesce(sum(b) OVER (ORDER BY station_ord ROWS BETWEEN UNBOUNDED PRECEDING
      AND 1 PRECEDING), 0) < {FIXTURE_CAP_BYTES} OR station_ord = {UNCAPPED_STATION} AS harvested FROM st),
v3 AS (SELECT v2.* FROM v2 JOIN g USING (station_ord) WHERE harvested),
a3 AS ({firsts("v3", "coalesce(res = 'SUCCESS', false) AND NOT restricted AND there IS NULL")}),
u3 AS ({used("a3", "(SELECT b FROM i)")}),
o3 AS (SELECT *, CASE WHEN used >= {FIXTURE_CAP_BYTES} AND station_ord <> {UNCAPPED_STATION} THEN 'SKIPPED' ELSE res END AS o FROM u3),
s3 AS (SELECT project_id, file_name, {last} AS status FROM o3 GROUP BY ALL)
SELECT project_id, file_name, coalesce(s3.status, s1.status) AS status FROM s1 LEFT JOIN s3 USING (project_id, file_name)"""


@query("two_run_status", oracle=_two_runs_sql())
def two_run_status(spark: SparkSession, d: str) -> DataFrame:
    """File statuses after two runs over the same visits.

    Run 1 starts empty with half the cap. Run 2 finds the files run 1 fetched on disk
    (their bytes are its initial bytes), has the full cap, one source without a cap, no
    log row for a third of the visits, and leaves out stations that start at the cap.
    """
    yes, key = F.lit(True), KEY_FILE
    visits = stored(_visits(spark, d), "visits")
    first = admit_by_budget(visits, WORK_ORDER, key, FIRST_CAP_BYTES, used=False)
    first = first.withColumn("outcome", capped_outcome(F.col("status"), F.col("capped"), yes))
    order = ["station_ord", "ord1", "ord2", "project_id", "file_name"]
    archive = stored(fold_file_status(first, key, order, result="outcome"), "first-run-status")  # read three times
    fetched = first.where((F.col("outcome") == rules.SUCCESS) & ~F.col("restricted"))
    initial = first_arrivals(fetched.select(*dict.fromkeys([*key, *WORK_ORDER])), key, WORK_ORDER).agg(F.coalesce(F.sum("size_bytes"), F.lit(0)).cast("bigint")).first()[0]
    there = archive.where(F.col("status") == rules.SUCCESS).select(*key, yes.alias("on_disk"))
    log = F.when(F.col("size_bytes") % 3 != 0, F.col("status"))
    again = visits.join(there, key, "left")
    again = stored(again.withColumn("outcome", visit_outcome(log, F.col("on_disk"), yes)), "second-run-visits")
    gate = station_gate(again, WORK_ORDER, key, FIXTURE_CAP_BYTES, initial, status="outcome", on_disk="on_disk")
    open_ = stored(gate.where(F.col("harvested") | (F.col("station_ord") == UNCAPPED_STATION)).select("station_ord"), "open-stations")
    again = again.join(F.broadcast(open_), "station_ord")  # a few stations: the visits stay where they are
    second = admit_by_budget(again, WORK_ORDER, key, FIXTURE_CAP_BYTES, initial, status="outcome",
                             uncapped=F.col("station_ord") == UNCAPPED_STATION, on_disk="on_disk", used=False)
    second = second.withColumn("outcome", capped_outcome(F.col("outcome"), F.col("capped"), yes))
    folded = stored(fold_file_status(second, key, order, result="outcome", existing=archive), "second-run-status")
    kept = archive.join(folded.select(*key), key, "left_anti")
    return folded.unionByName(kept)


# ---------------------------------------------------------------- fetch outcome (F8, H6)

# Attempts of the fixture's log that end in an error other than HTTP or transport.
OTHER_ERROR = "http_status IS NULL AND seq % 3 = 0"


@query("fetch_outcome", oracle=f"""
WITH a AS (SELECT file_id, row_number() OVER (PARTITION BY file_id ORDER BY seq, http_status NULLS FIRST) AS rn,
             CASE WHEN {OTHER_ERROR} THEN 'FAILED' WHEN http_status IN (401, 403) THEN 'RESTRICTED'
                  WHEN http_status IS NOT NULL AND http_status < 400 THEN 'SUCCESS' END AS t
           FROM fx_fetch_log),
k AS (SELECT * FROM a WHERE rn <= 3)
SELECT file_id, coalesce(min(CASE WHEN t IS NOT NULL THEN {{'r': rn, 't': t}} END).t, 'FAILED') AS outcome,
  CAST(coalesce(min(CASE WHEN t IS NOT NULL THEN rn END), count(*)) AS INTEGER) AS attempts
FROM k GROUP BY file_id""")
def fetch_outcome(spark: SparkSession, d: str) -> DataFrame:
    log = fx(spark, d, "fx_fetch_log").withColumn("other_error", F.expr(OTHER_ERROR))
    return fetch_outcome_op(log, other_error_col="other_error")
