"""CSV export (B1, B2).

CSV follows the original export: a header row, minimal quoting with doubled
quotes, NULL written as an empty field (so NULL and ``''`` read back the same),
no trimming. Files are Spark part files in a folder per table, written in
parallel and compressed (gzip, which any CSV reader opens; a file with quoted line ends
is read whole by one task either way); nothing is gathered on the driver.

The versioned archive store (B4) lives in ``cataloguer.sources.store``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import merge as M
from ..session import scratch_path
from . import sqltext as S
from .archive import _ARCHIVE_FILES_SQL, archive_files, fx, projects_full
from .registry import ORACLE_TEXT, query

CSV_WRITE = {
    "header": "true", "quote": '"', "escape": '"', "nullValue": "", "emptyValue": "",
    "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false", "compression": "gzip",
}
CSV_READ = {"header": "true", "quote": '"', "escape": '"', "nullValue": "", "multiLine": "true",
            "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}

TABLES = ["projects", "files", "keywords", "person_role", "licenses", "projects_full"]


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).options(**CSV_WRITE).csv(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.schema(schema).options(**CSV_READ).csv(path)


def export_all(tables: dict[str, DataFrame], out_dir: str, mode: str = "errorifexists") -> dict[str, str]:
    """Write each table as a CSV folder ``out_dir/<name>``; returns the paths."""
    paths = {}
    for name, df in tables.items():
        paths[name] = f"{out_dir.rstrip('/')}/{name}"
        write_csv(df, paths[name], mode)
    return paths


# ---------------------------------------------------------------- query

FX_PROJECTS_SCHEMA = (
    "id bigint, query_string string, repository_id int, repository_url string, project_url string, "
    "version string, title string, description string, language string, doi string, upload_date string, "
    "download_repository_folder string, download_project_folder string, download_method string"
)


@query("export_projects_roundtrip", oracle="""
SELECT id, query_string, repository_id, repository_url, project_url, version, title, description, language, doi,
  upload_date, download_repository_folder, download_project_folder, download_method FROM fx_projects""")
def export_projects_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """Write the projects table as CSV into the shared scratch folder and read it back."""
    path = scratch_path(spark, "export-projects")
    write_csv(fx(spark, d, "fx_projects"), path)
    return read_csv(spark, path, FX_PROJECTS_SCHEMA)


# ---------------------------------------------------------------- all six outputs

_KW = S.strip("keyword")
_NAME = S.strip("name")
_LIC = S.strip("license")
_TABLE_SQL = {
    "projects": "SELECT * FROM fx_projects",
    "files": _ARCHIVE_FILES_SQL,
    "keywords": f"SELECT DISTINCT project_id, {_KW} AS keyword FROM fx_keywords_raw WHERE {_KW} <> ''",
    "person_role": f"SELECT DISTINCT project_id, {_NAME} AS name, {S.role('role')} AS role FROM fx_persons_raw WHERE {_NAME} <> ''",
    "licenses": f"SELECT DISTINCT project_id, {S.license(_LIC)} AS license FROM fx_licenses_raw WHERE {_LIC} <> ''",
    "projects_full": ORACLE_TEXT["projects_full"],
}
_COLUMNS = {
    "projects": [c.split()[0] for c in FX_PROJECTS_SCHEMA.split(", ")],
    "files": ["project_id", "file_name", "file_type", "status"],
    "keywords": ["project_id", "keyword"],
    "person_role": ["project_id", "name", "role"],
    "licenses": ["project_id", "license"],
    "projects_full": ["project_id", "repository_id", "project_url", "title", "description", "version", "file_name", "status", "keywords", "persons", "licenses"],
}


def _digest_sql(name: str) -> str:
    text = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in _COLUMNS[name])
    return f"""SELECT '{name}' AS table_name, count(*) AS n_rows,
  CAST(sum(CAST('0x' || substr(md5(concat_ws('|', {text})), 1, 8) AS BIGINT)) AS BIGINT) AS digest FROM ({_TABLE_SQL[name]}) t"""


@query("export_all_tables", oracle="\nUNION ALL\n".join(_digest_sql(n) for n in TABLES))
def export_all_tables(spark: SparkSession, d: str) -> DataFrame:
    """Write the six outputs as CSV, read them back and digest every row of each."""
    frames = {
        "projects": fx(spark, d, "fx_projects"),
        "files": archive_files(spark, d),
        "keywords": M.clean_keywords(fx(spark, d, "fx_keywords_raw")).distinct(),
        "person_role": M.clean_persons(fx(spark, d, "fx_persons_raw")).distinct(),
        "licenses": M.clean_licenses(fx(spark, d, "fx_licenses_raw")).distinct(),
        "projects_full": projects_full(spark, d),
    }
    paths = export_all(frames, scratch_path(spark, "export"))
    out = None
    for name in TABLES:
        back = read_csv(spark, paths[name], frames[name].schema)
        text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in _COLUMNS[name]])
        number = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
        one = back.agg(F.count(F.lit(1)).alias("n_rows"), F.sum(number).alias("digest")).select(F.lit(name).alias("table_name"), "n_rows", "digest")
        out = one if out is None else out.unionByName(one)
    return out
