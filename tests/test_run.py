"""End-to-end harvest run: adapters -> versioned archive; rerun is idempotent."""

import pytest
from pyspark.sql import functions as F

from cataloguer import archive_run
from cataloguer.archive_run import run_harvest
from cataloguer.operators import merge as M
from cataloguer.plans import runs
from cataloguer.session import scratch_path
from cataloguer.sources import adapters, store

from .conftest import SMALL


def test_run_twice_is_idempotent_and_consistent(spark):
    base = scratch_path(spark, "t-run")
    srcs = [runs.dataverse_source(spark, SMALL), runs.oai_source(spark, SMALL)]
    first = run_harvest(spark, srcs, f"{base}/a", "2026-01-01T00:00:00+00:00", ledger_path=f"{base}/l")
    n_proj = first.projects.count()
    keys = srcs[0].projects.select("repository_id", "project_url")
    keys = keys.unionByName(srcs[1].projects.select("repository_id", "project_url"))
    assert n_proj == keys.distinct().count()  # records sharing a URL collapse into one project
    assert first.projects.select("repository_id", "project_url").distinct().count() == n_proj
    assert first.files.select("project_id", "file_name").distinct().count() == first.files.count()
    for t in (first.files, first.keywords, first.person_role, first.licenses):
        assert M.orphans(t, first.projects).count() == 0
    statuses = {r[0] for r in first.files.select("status").distinct().collect()}
    assert statuses <= {"SKIPPED", "RESTRICTED"}  # nothing fetched without an outcome log
    snap = sorted(tuple(r) for r in first.projects.collect())
    # second run: the ledger now lists everything, so nothing is pending and nothing changes
    second = run_harvest(spark, srcs, f"{base}/a", "2026-02-01T00:00:00+00:00", ledger_path=f"{base}/l")
    assert second.new_projects.count() == 0
    assert sorted(tuple(r) for r in second.projects.collect()) == snap


def test_run_with_outcomes_and_cap(spark):
    base = scratch_path(spark, "t-run2")
    src = runs.dataverse_source(spark, SMALL)
    src.files = src.files.withColumn("size", F.lit(10).cast("bigint"))
    srcs = [src]
    urls = src.files.select("file_url").distinct()
    outcomes = urls.select("file_url", F.when(F.xxhash64("file_url") % 3 == 0, "FAILED").otherwise("SUCCESS")
                           .alias("outcome"))
    res = run_harvest(spark, srcs, f"{base}/a", "2026-01-01T00:00:00+00:00", fetch_outcomes=outcomes, cap_bytes=25)
    got = {r[0]: r[1] for r in res.files.groupBy("status").count().collect()}
    assert got.get("SUCCESS", 0) >= 2 and got.get("SKIPPED", 0) >= 1
    ok_bytes = 10 * got["SUCCESS"]
    assert ok_bytes < 25 + 10  # only the file that crosses the cap is still taken


def _statuses(res):
    names = res.files.join(res.projects.select(F.col("id").alias("project_id"), "project_url"), "project_id")
    return {(r.project_url, r.file_name): r.status for r in names.collect()}


def test_rerun_skips_capped_files_and_counts_disk_bytes_once(spark):
    """Capped files have no log row and become SKIPPED; a file on disk is SUCCESS and adds nothing."""
    base = scratch_path(spark, "t-run3")
    src = runs.dataverse_source(spark, SMALL)
    src.files = src.files.withColumn("size", F.lit(10).cast("bigint")).withColumn("restricted", F.lit(False))
    log = src.files.select("file_url", F.lit("SUCCESS").alias("outcome")).distinct()
    first = run_harvest(spark, [src], f"{base}/a", "2026-01-01T00:00:00+00:00", fetch_outcomes=log, cap_bytes=35)
    fetched = {k for k, v in _statuses(first).items() if v == "SUCCESS"}
    assert len(fetched) == 4
    there = first.files.where("status = 'SUCCESS'").join(first.projects.select(F.col("id").alias("project_id"), *runs.adapters.KEY), "project_id")
    disk = src.files.join(there.select(*runs.adapters.KEY, "file_name"), [*runs.adapters.KEY, "file_name"]).select("local_path")
    none = log.limit(0)
    again = run_harvest(spark, [src], f"{base}/a", "2026-02-01T00:00:00+00:00", fetch_outcomes=log, cap_bytes=55, initial_bytes=40, on_disk=disk)
    assert sum(v == "SUCCESS" for v in _statuses(again).values()) == 6 and fetched <= {k for k, v in _statuses(again).items() if v == "SUCCESS"}
    full = run_harvest(spark, [src], f"{base}/b", "2026-02-01T00:00:00+00:00", fetch_outcomes=none, cap_bytes=30, initial_bytes=30)
    assert full.projects.count() == 0  # every station starts at the cap
    open_ = run_harvest(spark, [src], f"{base}/c", "2026-02-01T00:00:00+00:00", fetch_outcomes=log, cap_bytes=10, initial_bytes=5)
    got = _statuses(open_)
    assert sum(v == "SUCCESS" for v in got.values()) == 1 and set(got.values()) == {"SUCCESS", "SKIPPED"}


def test_a_crash_between_versions_leaves_the_old_one(spark):
    from cataloguer.sources import store

    base = scratch_path(spark, "t-store")
    store.write_version(spark, spark.range(3), base, "files")
    spark.range(9).write.parquet(f"{base}/files/v2")
    fs, mark, _ = store._fs(spark, f"{base}/files/v2/_SUCCESS")
    fs.delete(mark, False)  # the write did not finish
    assert store.read_current(spark, base, "files").count() == 3
    assert store.write_version(spark, spark.range(5), base, "files") == 3
    assert store.read_current(spark, base, "files").count() == 5


def test_ledger_errors(spark):
    from cataloguer.sources import ledger

    base = scratch_path(spark, "t-ledger")
    assert ledger.load_ledger(spark, f"{base}/none").count() == 0
    spark.createDataFrame([("not a ledger " * 9,)], "x string").coalesce(1).write.text(f"{base}/corrupt")
    assert ledger.load_ledger(spark, f"{base}/corrupt").count() == 0


COLUMNS = {
    "projects": "seq long, source string, repository_id int, project_url string, " + ", ".join(
        f"{c} string" for c in archive_run.PROJECT_COLS if c not in ("repository_id", "project_url", "download_date")) + ", has_qda boolean",
    "files": "seq long, repository_id int, project_url string, file_index int, file_name string, file_type string, file_url string, "
             "size long, restricted boolean, local_path string",
    "keywords": "seq long, repository_id int, project_url string, pos int, keyword string",
    "persons": "seq long, repository_id int, project_url string, pos int, name string, role string",
    "licenses": "seq long, repository_id int, project_url string, pos int, license string",
}


def small_source(spark, n):
    """A station's tables of ``n`` projects; children come in an order that is not that of the alphabet."""
    key = lambda i: (i, 5, f"https://x.example/{(7 * i) % n}")
    fixed = {"repository_url": "https://x.example", "download_repository_folder": "X", "download_project_folder": "p", "download_method": "API-CALL"}
    names = [c.split()[0] for c in COLUMNS["projects"].split(", ")]
    projects = [tuple({"seq": i, "source": "X", "repository_id": 5, "project_url": key(i)[2], "title": f"t{i}", **fixed}.get(c) for c in names) for i in range(n)]
    frame = lambda name, rows: spark.createDataFrame(rows, COLUMNS[name])
    return adapters.SourceTables(
        "dans", frame("projects", projects),
        frame("files", [(*key(i), k, f"f{9 - k}.pdf", "pdf", f"u/{i}/{k}", 1, k == 1, f"X/{i}/{k}") for i in range(n) for k in range(2)]),
        frame("keywords", [(*key(i), k, f"{'zma'[k]}{i}") for i in range(n) for k in range(3)]),
        frame("persons", [(*key(i), 0, f"Z{n - i}", "AUTHOR") for i in range(n)]),
        frame("licenses", [(*key(i), 0, "CC0 1.0") for i in range(n)]),
    )


def tables_of(spark, base):
    read = lambda t: store.read_current(spark, base, t) if t == "files" else store.read_rows(spark, base, t)
    return {t: sorted(tuple(r) for r in read(t).collect()) for t in ("projects", "files", "keywords", "person_role", "licenses")}


def test_a_stopped_run_goes_on_where_it_was(spark, monkeypatch):
    """Stopped in its second batch and started again: the same tables and ids as one run, no batch done twice."""
    base, ts = scratch_path(spark, "t-batches"), "2026-01-01T00:00:00+00:00"
    src, real, calls = small_source(spark, 10), archive_run.L.save_completed, []
    run_harvest(spark, [src], f"{base}/one", ts, f"{base}/one-ledger")

    def stops(completed, path, stamp=None):
        if len(calls) == 1:  # merged, but not yet in the ledger
            calls.append("stopped")
            raise KeyboardInterrupt
        calls.append(completed.count())
        real(completed, path, stamp)

    monkeypatch.setattr(archive_run.L, "save_completed", stops)
    with pytest.raises(KeyboardInterrupt):
        archive_run.run_in_batches(spark, [src], f"{base}/many", ts, f"{base}/ledger", save_every=4)
    assert archive_run.run_in_batches(spark, [src], f"{base}/many", ts, f"{base}/ledger", save_every=4) == 2
    assert calls == [4, "stopped", 4, 2]
    assert tables_of(spark, f"{base}/many") == tables_of(spark, f"{base}/one")
    saved = spark.read.parquet(f"{base}/ledger")
    assert saved.count() == saved.select("project_url").distinct().count() == 10
    assert saved.where("saved_at rlike '^20[0-9-]+T[0-9:]+[+]00:00$'").count() == 10
    assert archive_run.run_in_batches(spark, [src], f"{base}/many", ts, f"{base}/ledger", save_every=4) == 0


def test_child_ids_follow_arrival(spark):
    base = scratch_path(spark, "t-arrival")
    res = run_harvest(spark, [small_source(spark, 4)], f"{base}/a", "2026-01-01T00:00:00+00:00")
    assert [r.keyword for r in res.keywords.orderBy("id").collect()] == [f"{c}{i}" for i in range(4) for c in "zma"]
    assert [r.name for r in res.person_role.orderBy("id").collect()] == ["Z4", "Z3", "Z2", "Z1"]
    assert [r.file_name for r in res.files.orderBy("id").collect()] == ["f9.pdf", "f8.pdf"] * 4


def test_a_run_reads_its_sources_once(spark):
    """The gate and the tables each worked out the files of the sources (page links, joins) again."""
    reads = spark.sparkContext.accumulator(0)

    def read(name):
        reads.add(1)
        return name

    src = small_source(spark, 6)
    src.files = src.files.withColumn("file_name", F.udf(read, "string")("file_name"))
    res = run_harvest(spark, [src], f"{scratch_path(spark, 't-once')}/a", "2026-01-01T00:00:00+00:00")
    assert res.files.count() == 12 and reads.value == 12
