"""Dataverse payload adapters.

Search pages and dataset details are landed as JSON text (or JSON-lines files).
Search pages have a fixed shape and go through ``from_json`` with an explicit
schema. Dataset details are polymorphic (a citation ``value`` is a string, an
array of strings or an array of objects depending on ``typeName``; the licence is
an object or a plain string), so they are parsed once into a VARIANT and read
with ``try_variant_get`` by shape. Everything stays JVM-side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import blank_to_null, file_extension, safe_name
from ..functions.arrays import computed, explode_rows

SEARCH_ITEM = "struct<global_id: string, name: string, url: string, published_at: string, pos: bigint>"
SEARCH_PAGE_SCHEMA = f"data struct<total_count: bigint, items: array<{SEARCH_ITEM}>>"
LANDING_COLS = ["station_ord", "keyword_ord", "start"]

CITATION_FIELDS_T = "array<struct<typeName: string, value: variant>>"
FILES_T = ("array<struct<restricted: boolean, dataFile: struct<id: bigint, filename: string, "
           "filesize: bigint, restricted: boolean>>>")


# ---------------------------------------------------------------- search pages (A1)

def search_hits(pages: DataFrame, payload: str = "payload", landing: list[str] = LANDING_COLS) -> DataFrame:
    """One row per hit of each landed search page, with its position in the page."""
    parsed = pages.select(*landing, F.from_json(F.col(payload), SEARCH_PAGE_SCHEMA).alias("_p"))
    parsed = parsed.select(*landing, F.col("_p.data.total_count").alias("total_count"), F.col("_p.data.items").alias("_i"))
    out = explode_rows(parsed, F.col("_i"), [*landing, "total_count"], "item", pos="item_index")
    return out.select(*landing, "total_count", "item_index", "item.*")


def read_landed_pages(spark: SparkSession, path: str) -> DataFrame:
    """Good search pages of landed JSON-lines files: ``station_ord, keyword_ord, start, payload``.

    A line is a request's ``start`` and the ``body`` as it came; station and term are read from
    the file's folder (``station_ord=<n>/keyword_ord=<n>``). A term ends before its first page whose
    line or body is no JSON, or that has no hits (D8).
    """
    raw = (
        spark.read.schema("start bigint, body string, _corrupt string").option("columnNameOfCorruptRecord", "_corrupt")
        .option("recursiveFileLookup", "true").json(path).withColumn("_file", F.col("_metadata.file_path"))
    )
    part = lambda name: F.regexp_extract("_file", f"/{name}=([0-9]+)/", 1).cast("int").alias(name)
    # a line that is no JSON has no start: nothing of its term is sure, so the term ends at once
    parsed = F.from_json("body", SEARCH_PAGE_SCHEMA)
    pages = raw.select(
        part("station_ord"), part("keyword_ord"), F.when(F.col("_corrupt").isNotNull(), F.lit(-1)).otherwise(F.col("start")).alias("start"),
        F.col("body").alias("payload"), parsed["data"]["items"].alias("items"), F.col("_corrupt").alias("error_code"))
    return pages_until_stop(pages).drop("items", "error_code")


def pages_until_stop(pages: DataFrame, items: str = "items", error: str = "error_code",
                     term: tuple[str, ...] = ("station_ord", "keyword_ord"), start: str = "start") -> DataFrame:
    """D8 for search pages: per (station, term) keep pages before the first failed or empty one.

    The first stop per term is an aggregate (one row per station and term), joined
    back on the term key; Spark broadcasts it below its own size threshold.
    """
    term = list(term)
    bad = F.col(error).isNotNull() | F.coalesce(F.size(items) <= 0, F.lit(True))
    stop = pages.where(bad).groupBy(*term).agg(F.min(start).alias("_stop"))
    j = pages.join(stop, term, "left")
    return j.where(F.col("_stop").isNull() | (F.col(start) < F.col("_stop"))).drop("_stop")


# ---------------------------------------------------------------- dataset details (A2)

def parse_details(df: DataFrame, json_col: str = "json", keep: list[str] | None = None) -> DataFrame:
    """``latestVersion`` pieces of a dataset detail: version numbers, licence, citation fields, files.

    Missing objects read as NULL / empty, as the harvester's ``.get(..., {})`` chain does. A
    payload that is no JSON (an HTML error body) has none, so D2 drops that dataset and the run goes on.
    """
    keep = keep or [c for c in df.columns if c != json_col]
    latest = F.try_variant_get(F.try_parse_json(F.col(json_col)), "$.data.latestVersion", "variant")
    return computed(df, keep, [latest.alias("_latest")]).select(
        *keep,
        F.try_variant_get("_latest", "$.versionNumber", "string").alias("version_major"),
        F.try_variant_get("_latest", "$.versionMinorNumber", "string").alias("version_minor"),
        F.try_variant_get("_latest", "$.releaseTime", "string").alias("release_time"),
        F.try_variant_get("_latest", "$.license", "variant").alias("license_v"),
        F.coalesce(F.try_variant_get("_latest", "$.metadataBlocks.citation.fields", CITATION_FIELDS_T),
                   F.array().cast(CITATION_FIELDS_T)).alias("fields"),
        F.coalesce(F.try_variant_get("_latest", "$.files", FILES_T), F.array().cast(FILES_T)).alias("files"),
    )


def citation_value(fields: Column | str, type_name: str) -> Column:
    """``value`` of the field with ``typeName``; when repeated, the last one wins."""
    f = F.col(fields) if isinstance(fields, str) else fields
    return F.try_element_at(F.filter(f, lambda x: x["typeName"] == F.lit(type_name)), F.lit(-1))["value"]


def description(fields="fields") -> Column:
    """First ``dsDescription`` value, NULL when absent or empty."""
    v = citation_value(fields, "dsDescription")
    return blank_to_null(F.try_variant_get(v, "$[0].dsDescriptionValue.value", "string"))


def language(fields="fields") -> Column:
    """Array of languages joined by ``', '``, or the plain string; NULL when empty."""
    v = citation_value(fields, "language")
    as_list = F.array_join(F.try_variant_get(v, "$", "array<string>"), ", ")
    as_str = F.when(F.schema_of_variant(v) == "STRING", F.try_variant_get(v, "$", "string"))
    return blank_to_null(F.coalesce(as_list, as_str))


def version(major="version_major", minor="version_minor") -> Column:
    """``v{major}.{minor}``; NULL without a major; a NULL minor prints ``None``."""
    return F.when(F.col(major).isNotNull(),
                  F.concat(F.lit("v"), F.col(major), F.lit("."), F.coalesce(F.col(minor), F.lit("None"))))


def upload_date(published_at: Column, release_time: Column) -> Column:
    """Publication date of the search item, if empty the version's release time, else NULL."""
    return F.coalesce(blank_to_null(published_at), blank_to_null(release_time))


def keywords(fields="fields") -> Column:
    """Keyword values (last ``keyword`` field), then string subjects; blanks dropped."""
    kw = F.try_variant_get(citation_value(fields, "keyword"), "$", "array<struct<keywordValue: struct<value: string>>>")
    kw_vals = F.transform(F.coalesce(kw, F.array().cast("array<struct<keywordValue: struct<value: string>>>")),
                          lambda x: x["keywordValue"]["value"])
    subj = F.coalesce(F.try_variant_get(citation_value(fields, "subject"), "$", "array<variant>"),
                      F.array().cast("array<variant>"))
    subj_vals = F.transform(F.filter(subj, lambda x: F.schema_of_variant(x) == "STRING"),
                            lambda x: F.try_variant_get(x, "$", "string"))
    both = F.concat(kw_vals, subj_vals)
    return F.filter(both, lambda x: x.isNotNull() & (x != ""))


def authors(fields="fields") -> Column:
    """Author names (role AUTHOR), blanks dropped."""
    t = "array<struct<authorName: struct<value: string>>>"
    a = F.coalesce(F.try_variant_get(citation_value(fields, "author"), "$", t), F.array().cast(t))
    names = F.transform(a, lambda x: x["authorName"]["value"])
    return F.filter(names, lambda x: x.isNotNull() & (x != ""))


def license_value(lic="license_v") -> Column:
    """Object -> name, else uri; plain value -> its string; empty or null -> NULL."""
    v = F.col(lic) if isinstance(lic, str) else lic
    is_obj = F.schema_of_variant(v).startswith("OBJECT")
    obj = F.coalesce(blank_to_null(F.try_variant_get(v, "$.name", "string")),
                     blank_to_null(F.try_variant_get(v, "$.uri", "string")))
    plain = blank_to_null(F.try_variant_get(v, "$", "string"))
    return F.when(v.isNull() | F.is_variant_null(v), F.lit(None).cast("string")).when(is_obj, obj).otherwise(plain)


def dataset_files(details: DataFrame, api_base: Column | str, keep: list[str]) -> DataFrame:
    """One row per listed file: name (fallback ``file_{id}``), type, size, URL, restricted flag."""
    api = F.lit(api_base) if isinstance(api_base, str) else api_base
    x = explode_rows(details, F.col("files"), keep, "f", pos="file_index")
    fid = F.col("f.dataFile.id")
    name = F.coalesce(F.col("f.dataFile.filename"), F.concat(F.lit("file_"), F.coalesce(fid.cast("string"), F.lit("None"))))
    return x.select(
        *keep, "file_index", fid.alias("file_id"), name.alias("file_name"),
        file_extension(name).alias("file_type"), F.col("f.dataFile.filesize").alias("file_size"),
        (F.coalesce(F.col("f.restricted"), F.lit(False)) | F.coalesce(F.col("f.dataFile.restricted"), F.lit(False)))
        .alias("restricted"),
        F.concat(api, F.lit("/access/datafile/"), F.coalesce(fid.cast("string"), F.lit("None"))).alias("file_url"),
    )


def project_folder(doi: Column, title: Column) -> Column:
    """``safe_name('{doi with : and / as _}_{title}')``."""
    safe_id = F.translate(F.coalesce(doi, F.lit("")), ":/", "__")
    return safe_name(F.concat(safe_id, F.lit("_"), F.coalesce(title, F.lit("None"))))


def version_folder(ver: Column) -> Column:
    return F.when(ver.isNotNull(), safe_name(ver))
