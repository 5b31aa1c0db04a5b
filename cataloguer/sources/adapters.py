"""Source adapters (M1): landed payload DataFrames in, the five archive-bound tables out.

An adapter is a plain function from raw DataFrames to a ``SourceTables``:
projects (one row per project, with its arrival ``seq``), files, keywords,
persons and licences, children keyed by the project's natural key
``(repository_id, project_url)``. ``ADAPTERS`` registers them by source name;
a new catalogue only needs a new function.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import rules
from ..functions.normalise import file_class
from ..functions.text import blank_to_null
from ..operators.dedup import first_hit_per_station
from ..operators.ordering import with_ordinal
from ..session import stored
from . import dataverse as DV
from . import html, oai
from ..functions.arrays import computed, explode_rows

KEY = ["repository_id", "project_url"]
PLACE = ["seq", *KEY]  # children arrive by their project's place, then by their own (``pos``)


@dataclass
class SourceTables:
    """Archive-bound rows of one source, in arrival order (``seq``; children also ``pos``)."""

    source: str
    projects: DataFrame
    files: DataFrame
    keywords: DataFrame
    persons: DataFrame
    licenses: DataFrame


def _stations(spark) -> DataFrame:
    rows = [(i, s[0], s[2], s[3], s[4], s[5], s[6]) for i, s in enumerate(rules.STATIONS)]
    return spark.createDataFrame(
        rows, "station_ord int, station_key string, station_name string, station_url string, api_base string, "
              "folder string, access_method string")


def _term(keyword_ord: Column) -> Column:
    terms = F.array(*[F.lit(t) for t in rules.SEARCH_TERMS])
    return F.try_element_at(terms, keyword_ord.cast("int"))


def dataverse(hits: DataFrame, details: DataFrame, order: tuple[str, ...] = ("keyword_ord", "start", "item_index"),
              ) -> SourceTables:
    """Dataverse stations: first hit per station, detail check, first valid station, work order.

    ``hits``: ``station_ord, keyword_ord, start, item_index, global_id, name, url,
    published_at`` (as ``search_hits`` gives); ``details``: ``station_ord,
    global_id, json`` (the dataset detail as fetched from that station).
    """
    spark = hits.sparkSession
    order = list(order)
    item = ["name", "url", "published_at"]
    first = first_hit_per_station(hits, order=order + item)
    det = DV.parse_details(details, keep=["station_ord", "global_id"])
    has_qda = F.exists("files", lambda f: file_class(F.coalesce(f["dataFile"]["filename"], F.lit(""))) == "qda")
    parsed = [c for c in det.columns if c not in ("station_ord", "global_id", "files")]
    valid = computed(det, [F.col("station_ord").alias("_asked"), "global_id", *parsed], [F.col("files"), has_qda.alias("has_qda")])
    # A DOI has a first hit and a detail per station at most, so the tables meet by the DOI
    # alone and the stations are compared after that: the payloads stay where the join by DOI
    # that landed them, and the choice of the owner below, need them, and are shuffled once.
    cand = first.join(valid.where(F.size("files") > 0), "global_id").where(F.col("station_ord") - F.col("_asked") == 0)
    # the first valid station per DOI; the parsed detail rides along in min_by's value
    # (only the ordering struct is compared), so details are parsed once
    carried = ["station_ord", *order, *item, "has_qda", *parsed, "files"]
    owner = cand.groupBy("global_id").agg(
        F.min_by(F.struct(*carried), F.struct("station_ord", *order, *item)).alias("_o"))
    owner = owner.select("global_id", *[F.col(f"_o.{c}").alias(c) for c in carried])
    full = owner.join(F.broadcast(_stations(spark)), "station_ord")

    title = F.coalesce(F.col("name"), F.lit("untitled"))
    ver = DV.version()
    ver_folder = DV.version_folder(ver)
    proj_folder = DV.project_folder(F.col("global_id"), title)
    base = full.select(
        "station_ord", *order, "station_name", "api_base", "global_id", "files",
        F.lit(5).alias("repository_id"), F.coalesce(F.col("url"), F.lit("")).alias("project_url"),
        _term(F.col("keyword_ord")).alias("query_string"), F.col("station_url").alias("repository_url"),
        ver.alias("version"), title.alias("title"), DV.description().alias("description"),
        DV.language().alias("language"), F.col("global_id").alias("doi"),
        DV.upload_date(F.col("published_at"), F.col("release_time")).alias("upload_date"),
        F.col("folder").alias("download_repository_folder"), proj_folder.alias("download_project_folder"),
        ver_folder.alias("download_version_folder"), F.col("access_method").alias("download_method"),
        F.col("has_qda"), DV.keywords().alias("_keywords"), DV.authors().alias("_authors"), DV.license_value().alias("_license"),
    )
    # all that the five tables need, as plain columns, is kept once: neither the sampling pass of
    # the ordinal nor a table parses a payload again, and a table reads its own columns only
    base = stored(base, "dataverse-base")
    base = with_ordinal(base, [F.col("station_ord"), ~F.col("has_qda"), *[F.col(c) for c in order], F.col("global_id")], name="seq",
                        compact=True)
    projects = base.select("seq", F.col("station_name").alias("source"), *KEY, "query_string", "repository_url",
                           "version", "title", "description", "language", "doi", "upload_date",
                           "download_repository_folder", "download_project_folder", "download_version_folder",
                           "download_method", "has_qda")
    files = DV.dataset_files(base, F.col("api_base"),
                             keep=["seq", *KEY, "api_base", "download_repository_folder", "download_project_folder",
                                   "download_version_folder"])
    files = files.select("seq", *KEY, "file_index", "file_name", "file_type", "file_url",
                         F.col("file_size").alias("size"), "restricted",
                         F.concat_ws("/", "download_repository_folder", "download_project_folder",
                                     "download_version_folder", "file_name").alias("local_path"))
    keywords = explode_rows(base, F.col("_keywords"), PLACE, "keyword", pos="pos")
    persons = explode_rows(base, F.col("_authors"), PLACE, "name", pos="pos").withColumn("role", F.lit("AUTHOR"))
    licenses = base.select(*PLACE, F.lit(0).alias("pos"), F.col("_license").alias("license")).where(F.col("license").isNotNull())
    return SourceTables("dans", projects, files, keywords, persons, licenses)


def oai_records(records: DataFrame, item_pages: DataFrame | None = None,
                order: tuple[str, ...] = ("page_no", "record_index"),
                page_files: DataFrame | None = None) -> SourceTables:
    """OAI-PMH source: hint-filtered records, files from their item pages.

    ``records``: ``parse_records``/``page_records`` output plus the arrival
    columns in ``order``; ``item_pages``: ``page_url, http_status, html``, or
    ``page_files``: ``html.page_files(..., placeholder=False)`` rows already keyed
    by ``page_url``.
    """
    order = list(order)
    rows = stored(oai.project_rows(records, keep=order).where("has_qda_hint"), "oai-rows")  # records are parsed once
    rows = with_ordinal(rows, [F.col(c) for c in order], name="seq", compact=True)
    st = rules.STATIONS[4]
    projects = rows.select(
        "seq", F.lit(st[0]).alias("source"), *KEY, "query_string", F.lit(st[3]).alias("repository_url"),
        F.lit(None).cast("string").alias("version"), "title", "description", "language", "doi", "upload_date",
        "download_repository_folder", "download_project_folder",
        F.lit(None).cast("string").alias("download_version_folder"), "download_method",
        F.lit(None).cast("boolean").alias("has_qda"),
    )
    # Files are extracted on the page rows (html stays in its scan task); only the
    # narrow file rows are joined to the projects by the page URL.
    if page_files is None:
        page_files = html.page_files(item_pages, keep=["page_url"], placeholder=False)
    want = rows.select("seq", *KEY, "download_repository_folder", "download_project_folder",
                       F.coalesce(blank_to_null(F.col("handle")), F.col("project_url")).alias("page_url"))
    files = want.join(page_files, "page_url", "left")
    files = files.select(
        "seq", *KEY, F.coalesce("file_index", F.lit(0)).alias("file_index"),
        F.coalesce("file_name", F.lit(rules.PLACEHOLDER_FILE_NAME)).alias("file_name"),
        F.when(F.col("file_name").isNull(), F.lit(rules.PLACEHOLDER_FILE_TYPE)).otherwise(F.col("file_type"))
        .alias("file_type"), "file_url", F.lit(None).cast("bigint").alias("size"),
        F.lit(False).alias("restricted"),
        F.when(F.col("file_name").isNotNull(), F.concat_ws("/", "download_repository_folder", "download_project_folder",
                                                           "file_name")).alias("local_path"),
    )
    keywords = explode_rows(rows, F.col("subjects"), PLACE, "keyword", pos="pos")
    persons = explode_rows(rows, F.concat(
        F.transform("creators", lambda n: F.struct(n.alias("name"), F.lit("AUTHOR").alias("role"))),
        F.transform("contributors", lambda n: F.struct(n.alias("name"), F.lit("CONTRIBUTOR").alias("role"))),
    ), PLACE, "p", pos="pos").select(*PLACE, "pos", "p.name", "p.role")
    licenses = explode_rows(rows, F.col("rights"), PLACE, "license", pos="pos")
    return SourceTables("uni_halle", projects, files, keywords, persons, licenses)


ADAPTERS: dict[str, Callable[..., SourceTables]] = {"dans": dataverse, "uni_halle": oai_records}
