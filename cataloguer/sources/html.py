"""Item-page HTML adapter.

All work is array functions on the page row itself: extract the bitstream links
with one regex pass, keep first occurrences, drop thumbnail/preview links, keep the
first link per file name. No explode before the filtering and no shuffle: the
``html`` column never leaves the scan's task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import rules
from ..functions.text import contains_any, file_extension
from ..functions.arrays import bind, explode_rows

BASE_URL = rules.STATIONS[4][3]


def bitstream_links(html: Column, http_status: Column) -> Column:
    """Distinct link paths in page order; pages that did not answer 200 give none."""
    links = F.array_distinct(F.regexp_extract_all(html, F.lit(rules.BITSTREAM_LINK_RE), 1))
    return F.when(http_status == 200, links).otherwise(F.array().cast("array<string>"))


def data_links(links: Column) -> Column:
    """Drop thumbnails and previews (substring test on the lower-cased path; the
    ``isAllowed=n`` pattern has a capital and so never matches, as in the original)."""
    return F.filter(links, lambda p: ~contains_any(F.lower(p), rules.LINK_SKIP_PATTERNS))


def _name(path: Column) -> Column:
    return F.element_at(F.split(F.element_at(F.split(path, "/"), -1), r"\?"), 1)


def files_of_links(links: Column) -> Column:
    """Array of (file_name, path): the first path per non-empty file name, in page order.

    The links are sorted by (name, place), the first of each name is kept and put back
    in page order, so a page costs n log n. Arrays that a lambda looks back into are
    bound to a lambda variable (``bind``): written as expressions they would be worked
    out again for every element.
    """
    named = F.transform(links, lambda p, i: F.struct(_name(p).alias("n"), i.alias("i"), p.alias("path")))

    def firsts(a: Column) -> Column:
        return F.filter(a, lambda x, k: (x["n"] != "") & ((k == 0) | (F.get(a, k - 1)["n"] != x["n"])))

    kept = F.transform(bind(F.sort_array(named), firsts), lambda x: F.struct(x["i"], x["n"], x["path"]))
    return F.transform(F.sort_array(kept), lambda x: F.struct(x["n"].alias("file_name"), x["path"].alias("path")))


def page_files(pages: DataFrame, keep: list[str], html: str = "html", status: str = "http_status",
               placeholder: bool = True) -> DataFrame:
    """One row per file of each page; a page without files gives the placeholder row."""
    files = files_of_links(data_links(bitstream_links(F.col(html), F.col(status))))
    x = pages.select(*keep, files.alias("_files"))
    if placeholder:
        x = x.select(*keep, F.posexplode_outer("_files").alias("file_index", "_f"))
    else:
        x = explode_rows(x, F.col("_files"), keep, "_f", pos="file_index")
    name = F.coalesce(F.col("_f.file_name"), F.lit(rules.PLACEHOLDER_FILE_NAME))
    ftype = F.when(F.col("_f").isNull(), F.lit(rules.PLACEHOLDER_FILE_TYPE)).otherwise(file_extension(name))
    url = F.when(F.col("_f").isNotNull(), F.concat(F.lit(BASE_URL.rstrip("/")), F.col("_f.path")))
    return x.select(*keep, F.coalesce(F.col("file_index"), F.lit(0)).alias("file_index"), name.alias("file_name"),
                    ftype.alias("file_type"), url.alias("file_url"), F.lit(None).cast("bigint").alias("size"),
                    F.lit(False).alias("restricted"))
