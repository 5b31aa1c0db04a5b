"""One harvest run over landed payloads, end to end (SURVEY section 3.1, "Ours").

    adapters (A, C, D) -> dedup (F1, F2) -> anti ledger (E2) -> work order (I4)
    -> budget (H2-H4) -> status (F7, F8) -> merge (F5, F6) -> ledger (F9, B3)

Append-only tables (projects, keywords, person_role, licenses) receive only
their new rows; the files table, whose statuses change, is written as a new
version (``sources/store.py``). Nothing is collected on the driver except the
scalar ``max(id)`` of each table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import rules
from .operators import merge as M
from .operators.budget import admit_by_budget, station_gate
from .operators.ordering import with_ordinal
from .operators.status import capped_outcome, fold_file_status, visit_outcome
from .session import stored
from .sources.store import append_rows, read_current, read_rows, write_version
from .sources import ledger as L
from .sources.adapters import KEY, SourceTables

PROJECT_COLS = [
    "query_string", "repository_id", "repository_url", "project_url", "version", "title", "description",
    "language", "doi", "upload_date", "download_date", "download_repository_folder", "download_project_folder",
    "download_version_folder", "download_method",
]
PROJECT_REQUIRED = ["repository_id", "repository_url", "project_url", "title", "download_date",
                    "download_repository_folder", "download_project_folder", "download_method"]

ARRIVAL = ("source_ord", "seq", "pos")  # of child rows: ids follow it


@dataclass
class RunResult:
    projects: DataFrame
    files: DataFrame
    keywords: DataFrame
    person_role: DataFrame
    licenses: DataFrame
    new_projects: DataFrame  # pending projects of this run, with their archive id


def _gated(pending: DataFrame, files: DataFrame, order: list[str], cap_bytes: int, initial_bytes: int,
           uncapped: list[int]) -> DataFrame:
    """``pending`` projects of the stations that are harvested (H3).

    A station that starts at or above the cap adds nothing at all. Stations are the
    ``source`` values in arrival order: a handful of rows.
    """
    stations = pending.groupBy("source_ord", "source").agg(F.min("seq").alias("_at"))
    numbered = stations.withColumn("station_ord", F.row_number().over(Window.orderBy("source_ord", "_at")))
    visits = files.join(pending.select("source_ord", "source", *KEY).distinct(), ["source_ord", *KEY]).join(
        numbered.select("source_ord", "source", "station_ord"), ["source_ord", "source"])
    gate = station_gate(visits, ["station_ord", *order], [*KEY, "file_name"], cap_bytes, initial_bytes, status="outcome",
                        on_disk="on_disk").select("station_ord", "harvested")
    kept = numbered.join(gate, "station_ord", "left").where(
        F.col("source_ord").isin(uncapped) | F.coalesce("harvested", F.lit(initial_bytes < cap_bytes)))
    return pending.join(kept.select("source_ord", "source"), ["source_ord", "source"], "left_semi")


def run_harvest(spark: SparkSession, sources: list[SourceTables], archive_base: str, run_ts: str,
                ledger_path: str | None = None, fetch_outcomes: DataFrame | None = None,
                cap_bytes: int | None = rules.DOWNLOAD_TARGET_BYTES, initial_bytes: int = 0,
                on_disk: DataFrame | None = None, saved_at: str | None = None) -> RunResult:
    """Merge the sources (in the given order) into the archive.

    ``fetch_outcomes``: ``file_url, outcome`` (see ``operators.status.fetch_outcome``);
    without it no file is downloaded and statuses stay at their initial value.
    Dataverse files are subject to ``cap_bytes``; OAI files are not, but their bytes count.
    ``on_disk``: ``local_path`` of the files that are there before the run. They are
    SUCCESS without an attempt, and their bytes are part of ``initial_bytes``.
    A Dataverse station that starts at or above the cap is not harvested.
    """
    ledger = L.load_ledger(spark, ledger_path) if ledger_path else L.empty_ledger(spark)
    tagged = list(enumerate(sources))

    # ---- projects
    proj = None
    for i, s in tagged:
        p = s.projects.withColumn("source_ord", F.lit(i))
        proj = p if proj is None else proj.unionByName(p, allowMissingColumns=True)
    pending = L.pending(proj, ledger).withColumn("download_date", F.lit(run_ts))
    order = ["source_ord", "seq", "file_index", "file_name"]
    uncapped = [i for i, s in tagged if s.source == "uni_halle"]
    all_files = None
    for i, s in tagged:
        f = s.files.withColumn("source_ord", F.lit(i))
        all_files = f if all_files is None else all_files.unionByName(f, allowMissingColumns=True)
    downloadable = F.col("file_url").isNotNull() & F.col("local_path").isNotNull()
    visited = all_files.withColumn("size_bytes", F.coalesce("size", F.lit(0)))
    if fetch_outcomes is not None:
        visited = visited.join(fetch_outcomes.select("file_url", "outcome"), "file_url", "left")
    else:
        visited = visited.withColumn("outcome", F.lit(None).cast("string"))
    if on_disk is not None:
        there = on_disk.select("local_path").distinct().withColumn("on_disk", F.lit(True))
        visited = visited.join(there, "local_path", "left")
    else:
        visited = visited.withColumn("on_disk", F.lit(False))
    visited = visited.withColumn("outcome", visit_outcome(F.col("outcome"), F.col("on_disk"), downloadable))
    # written once, with what the gate, the budget and the files need: the sources' pages are not parsed for each again
    visited = stored(visited.select(*KEY, *order, "file_type", "size_bytes", "restricted", "outcome", "on_disk",
                                    downloadable.alias("downloadable")), "run-visits")
    if cap_bytes is not None:
        pending = _gated(pending, visited, order, cap_bytes, initial_bytes, uncapped)
    pending = stored(pending, "run-pending")  # read by every table; ledger and gate are looked up once
    batch = M.drop_not_null_violations(pending.select("source_ord", "seq", *PROJECT_COLS), PROJECT_REQUIRED)
    added = M.new_rows(read_rows(spark, archive_base, "projects"), batch, KEY, ["source_ord", "seq"],
                       columns=PROJECT_COLS)
    append_rows(added, archive_base, "projects")
    projects = read_rows(spark, archive_base, "projects")
    ids = projects.select(F.col("id").alias("project_id"), *KEY)
    # one archive id per natural key of this run's pending projects (records that share
    # a key share the project, as the original's insert-then-look-up does)
    new_ids = stored(ids.join(pending.select(*KEY), KEY, "left_semi"), "run-ids")
    new_projects = pending.select("source", "source_ord", "seq", *KEY).join(ids, KEY)

    def children(attr: str) -> DataFrame:
        out = None
        for i, s in tagged:
            c = getattr(s, attr).withColumn("source_ord", F.lit(i))
            out = c if out is None else out.unionByName(c, allowMissingColumns=True)
        return of_pending(out)

    def of_pending(rows: DataFrame) -> DataFrame:
        # The natural key resolves to the archive id; only pending projects are written
        return rows.join(new_ids, KEY)

    # ---- keywords / persons / licences
    for table, rows, key in [
        ("keywords", M.clean_keywords(children("keywords"), ARRIVAL), ["project_id", "keyword"]),
        ("person_role", M.clean_persons(children("persons"), ARRIVAL), ["project_id", "name", "role"]),
        ("licenses", M.clean_licenses(children("licenses"), ARRIVAL), ["project_id", "license"]),
    ]:
        append_rows(M.new_rows(read_rows(spark, archive_base, table), rows, key, list(ARRIVAL), columns=key), archive_base, table)

    # ---- files: visits in work order, budget, outcome, status fold
    # each file keeps the arrival position of the record that listed it
    visits = of_pending(visited).drop(*KEY)
    if cap_bytes is not None:
        visits = admit_by_budget(visits, order, ["project_id", "file_name"], cap_bytes, initial_bytes, status="outcome",
                                 uncapped=F.col("source_ord").isin(uncapped), on_disk="on_disk", used=False)
        visits = visits.withColumn("outcome", capped_outcome(F.col("outcome"), F.col("capped"), F.col("downloadable")))
    existing = read_current(spark, archive_base, "files")
    merged = M.merge_into(existing, visits.select("project_id", "file_name", "file_type", *order),
                             ["project_id", "file_name"], order, columns=["project_id", "file_name", "file_type"])
    folded = fold_file_status(visits, ["project_id", "file_name"], order, restricted="restricted", result="outcome",
                              existing=existing)
    files = merged.join(folded, ["project_id", "file_name"], "left")
    if existing is not None:
        files = files.join(existing.select("project_id", "file_name", F.col("status").alias("_old")),
                           ["project_id", "file_name"], "left").withColumn("status", F.coalesce("status", "_old")).drop("_old")
    files = files.select("id", "project_id", "file_name", "file_type", "status")

    write_version(spark, files, archive_base, "files")

    if ledger_path:
        L.save_completed(new_projects, ledger_path, saved_at)
    return RunResult(
        projects=projects, files=read_current(spark, archive_base, "files"),
        keywords=read_rows(spark, archive_base, "keywords"),
        person_role=read_rows(spark, archive_base, "person_role"),
        licenses=read_rows(spark, archive_base, "licenses"), new_projects=new_projects,
    )


def save_batches(sources: list[SourceTables], ledger: DataFrame, save_every: int) -> DataFrame:
    """Projects that the ledger does not list, with ``batch_no``: ``save_every`` projects a batch, in arrival order.

    Records that share a natural key are one project and lie in one batch. Written, as
    the batches are worked off while the ledger grows.
    """
    every = None
    for i, s in enumerate(sources):
        p = s.projects.select("source", F.lit(i).alias("source_ord"), "seq", *KEY)
        every = p if every is None else every.unionByName(p)
    first = M.first_arrivals(L.pending(every, ledger).select(*KEY, "source_ord", "seq"), KEY, ["source_ord", "seq"])
    numbered = with_ordinal(first, [F.col("source_ord"), F.col("seq")], name="_at")
    batch = F.floor((F.col("_at") - 1) / save_every).cast("long")
    return numbered.select(*KEY, batch.alias("batch_no")).checkpoint(eager=True)


def run_in_batches(spark: SparkSession, sources: list[SourceTables], archive_base: str, run_ts: str, ledger_path: str,
                   save_every: int = rules.PROGRESS_SAVE_INTERVAL, **settings) -> int:
    """``run_harvest`` that saves its progress every ``save_every`` projects; returns the batches it worked on.

    A batch is merged, then its projects enter the ledger in one write with the time of the
    save. A run that was stopped is started again with the same arguments: done batches
    are in the ledger and are not touched, the open one is merged again, which by the
    natural keys adds only what is missing. On a large catalogue ``save_every`` is set to
    what one Spark job is worth; the reference's 25 is the default.
    """
    batches = save_batches(sources, L.load_ledger(spark, ledger_path), save_every)
    last = batches.agg(F.max("batch_no")).first()[0]
    done = 0
    for n in range(0 if last is None else last + 1):
        mine = batches.where(F.col("batch_no") == n).select(*KEY)
        part = [SourceTables(s.source, *[t.join(mine, KEY, "left_semi") for t in (s.projects, s.files, s.keywords, s.persons, s.licenses)])
                for s in sources]
        run_harvest(spark, part, archive_base, run_ts, ledger_path, **settings)
        done += 1
    return done
