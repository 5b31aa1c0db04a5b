"""Invariants: merge idempotence, order independence, budget prefix, key uniqueness, resume."""

from pyspark.sql import functions as F

from cataloguer.operators import merge as M
from cataloguer.operators.budget import admit_by_budget
from cataloguer.operators.ordering import with_ordinal, with_running_sum
from cataloguer.plans import archive as A
from cataloguer.plans import reports as R
from cataloguer.sources import tables
from cataloguer.session import scratch_path
from cataloguer.streaming.incremental import merge_stream, run_until_drained

from .conftest import MEDIUM, SMALL


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_merge_twice_equals_once(spark):
    batch = M.clean_keywords(A.fx(spark, SMALL, "fx_keywords_raw"))
    once = M.merge_into(None, batch, ["project_id", "keyword"], [])
    twice = M.merge_into(once, batch, ["project_id", "keyword"], [])
    assert _rows(once) == _rows(twice)


def test_existing_row_wins(spark):
    archive = spark.createDataFrame([(1, 10, "a.txt", "txt", "FAILED")],
                                    "id long, project_id long, file_name string, file_type string, status string")
    batch = spark.createDataFrame([(10, "a.txt", 1, "txt", "SUCCESS"), (10, "b.txt", 2, "txt", "SKIPPED"),
                                   (10, "b.txt", 1, "txt", "RESTRICTED")],
                                  "project_id long, file_name string, seq long, file_type string, status string")
    out = M.merge_into(archive, batch, ["project_id", "file_name"], ["seq"],
                       columns=["project_id", "file_name", "file_type", "status"])
    assert _rows(out) == [(1, 10, "a.txt", "txt", "FAILED"), (2, 10, "b.txt", "txt", "RESTRICTED")]


def test_partition_order_does_not_matter(spark):
    raw = A.fx(spark, SMALL, "fx_files_raw")
    key, order = A.FILE_KEY, A.FILE_ORDER
    cols = ["project_id", "file_name", "status"]
    a = M.merge_into(None, raw.select(*key, *order, "status"), key, order, columns=cols)
    shuffled = raw.select(*key, *order, "status").repartition(7, F.rand(seed=3)).sortWithinPartitions(F.rand(seed=5))
    b = M.merge_into(None, shuffled, key, order, columns=cols)
    assert _rows(a) == _rows(b)


def test_natural_keys_unique_and_ids_dense(spark):
    m = A.merged_projects(spark, SMALL)
    n = m.count()
    assert m.select(*A.PROJECT_KEY).distinct().count() == n
    ids = sorted(r[0] for r in m.select("id").collect())
    assert ids == list(range(1, n + 1))


def test_ordinal_equals_row_number(spark):
    df = spark.range(0, 5000).select((F.col("id") % 37).alias("a"), (F.col("id") * 7 % 101).alias("b"), "id")
    out = with_ordinal(df, [F.col("a"), F.col("b"), F.col("id")], partitions=5)
    got = {r["id"]: r["ordinal"] for r in out.collect()}
    want = sorted(range(5000), key=lambda i: (i % 37, i * 7 % 101, i))
    assert [got[i] for i in want] == list(range(1, 5001))


def test_running_sum_exclusive(spark):
    df = spark.range(0, 3000).select("id", (F.col("id") % 13).alias("v"))
    out = with_running_sum(df, [F.col("id")], F.col("v"), partitions=6)
    got = {r["id"]: r["running"] for r in out.collect()}
    acc = 0
    for i in range(3000):
        assert got[i] == acc
        acc += i % 13


def test_budget_example(spark):
    df = spark.createDataFrame([(1, "a", 6, "SUCCESS", False), (2, "b", 6, "SUCCESS", False),
                                (3, "c", 6, "SUCCESS", False), (4, "d", 1, "SUCCESS", True)],
                               "seq long, name string, size_bytes long, status string, restricted boolean")
    out = admit_by_budget(df, ["seq"], ["name"], cap_bytes=10)
    got = [r["budget_status"] for r in out.orderBy("seq").collect()]
    assert got == ["SUCCESS", "SUCCESS", "SKIPPED", "RESTRICTED"]


def test_budget_repeated_path_adds_nothing_and_uncapped_counts(spark):
    df = spark.createDataFrame([(1, "a", 6, "SUCCESS", False, False), (2, "a", 6, "SUCCESS", False, False),
                                (3, "b", 5, "SUCCESS", False, True), (4, "c", 1, "SUCCESS", False, False),
                                (5, "d", 1, "SUCCESS", False, True)],
                               "seq long, name string, size_bytes long, status string, restricted boolean, oai boolean")
    out = admit_by_budget(df, ["seq"], ["name"], cap_bytes=10, uncapped=F.col("oai"))
    got = [(r["used_before"], r["budget_status"]) for r in out.orderBy("seq").collect()]
    assert got == [(0, "SUCCESS"), (6, "SUCCESS"), (6, "SUCCESS"), (11, "SKIPPED"), (12, "SUCCESS")]


def test_budget_admitted_is_prefix(spark):
    out = R.budget_admission(spark, MEDIUM).where(~F.col("restricted")).orderBy(*R.WORK_ORDER).collect()
    skipped = [r["budget_status"] == "SKIPPED" for r in out]
    if True in skipped:
        first = skipped.index(True)
        assert all(skipped[first:])
        assert out[first - 1]["used_before"] < R.FIXTURE_CAP_BYTES if first else True
        assert out[first]["used_before"] >= R.FIXTURE_CAP_BYTES


def test_no_orphans_against_own_parents(spark):
    files = A.archive_files(spark, SMALL)
    parents = A.fx(spark, SMALL, "fx_projects")
    assert M.orphans(files, parents).count() == 0


def test_stream_resume_processes_only_new_files(spark):
    base = scratch_path(spark, "t-stream")
    src, arc, ck = f"{base}/in", f"{base}/arc", f"{base}/ck"
    schema = "project_id bigint, keyword string"
    a = spark.createDataFrame([(1, "x"), (1, "y"), (2, "x")], schema)
    b = spark.createDataFrame([(1, "x"), (3, "z")], schema)
    a.write.parquet(src, mode="append")
    assert run_until_drained(merge_stream(spark, src, schema, arc, "kw", ["project_id", "keyword"], [], ck)) == 1
    assert run_until_drained(merge_stream(spark, src, schema, arc, "kw", ["project_id", "keyword"], [], ck)) == 0
    b.write.parquet(src, mode="append")
    assert run_until_drained(merge_stream(spark, src, schema, arc, "kw", ["project_id", "keyword"], [], ck)) == 1
    from cataloguer.sources.store import read_rows

    got = _rows(read_rows(spark, arc, "kw"))
    assert got == [(1, 1, "x"), (2, 1, "y"), (3, 2, "x"), (4, 3, "z")]


def test_stream_with_small_triggers_equals_batch(spark):
    base = scratch_path(spark, "t-stream2")
    src, arc, ck = f"{base}/in", f"{base}/arc", f"{base}/ck"
    schema = "project_id bigint, keyword string"
    for i in range(4):
        spark.createDataFrame([(i, "k"), (i + 1, "k")], schema).write.parquet(src, mode="append")
    q = merge_stream(spark, src, schema, arc, "kw", ["project_id", "keyword"], [], ck, max_files_per_trigger=1)
    assert run_until_drained(q) >= 1
    from cataloguer.sources.store import read_rows

    keys = sorted((r[1], r[2]) for r in read_rows(spark, arc, "kw").collect())
    assert keys == [(i, "k") for i in range(5)]


def test_fetch_outcome_rules(spark):
    from cataloguer.operators.status import fetch_outcome

    log = spark.createDataFrame([
        (1, 1, 503, False), (1, 2, None, False), (1, 3, 200, False),   # third attempt succeeds
        (2, 1, 503, False), (2, 2, 503, False), (2, 3, 503, False), (2, 4, 200, False),  # 4th is never made
        (3, 1, 403, False), (3, 2, 200, False),                          # restricted at once
        (4, 1, 500, False), (4, 2, None, True),                         # non-HTTP error: failed at once
        (5, 1, 302, False),                                               # < 400 is ok
    ], "file_id long, seq long, http_status int, other boolean")
    got = {r[0]: (r[1], r[2]) for r in fetch_outcome(log, other_error_col="other").collect()}
    assert got == {1: ("SUCCESS", 3), 2: ("FAILED", 3), 3: ("RESTRICTED", 1), 4: ("FAILED", 2), 5: ("SUCCESS", 1)}


def test_hot_key_is_split_and_combined(spark):
    """A third of all rows on one key: ordinals stay exact and the hot prefix is split over
    range partitions; first-arrival aggregation combines map-side before the shuffle."""
    from cataloguer.operators.ordering import _ranged

    n = 9000
    df = spark.range(0, n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("a"), (F.col("id") * 7 % n).alias("b"))
    ranged = _ranged(df, [F.col("a"), F.col("b")], 6)
    sizes = [r[1] for r in ranged.groupBy(F.shiftright("_mid", 33)).count().collect()]
    assert max(sizes) < n / 3  # the hot key (n/3 rows) did not land in one partition
    out = with_ordinal(df, [F.col("a"), F.col("b")], partitions=6)
    assert sorted(r[0] for r in out.select("ordinal").collect()) == list(range(1, n + 1))
    first = M.first_arrivals(df.withColumn("v", F.col("b")), ["a"], ["b"])
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan


def _child_frames(spark, monkeypatch):
    """Repeated, blank and null child rows in place of the fixture's, with tiny shares for a task."""
    frames = {
        "fx_projects": spark.createDataFrame([(1, 5), (2, 16), (3, 5)], "id long, repository_id int"),
        "fx_files_raw": spark.createDataFrame([(1, "a"), (2, "a"), (2, "a"), (2, None), (None, "b"), (9, "c")], "project_id long, file_name string"),
        "fx_keywords_raw": spark.createDataFrame([(1, "x"), (2, " x "), (2, "x"), (2, "y"), (7, " ")], "project_id long, keyword string"),
        "fx_persons_raw": spark.createDataFrame([(3, "p", "AUTHOR"), (None, "p", "AUTHOR"), (None, "p", "AUTHOR"), (None, "q", "x")], "project_id long, name string, role string"),
        "fx_licenses_raw": spark.createDataFrame([(1, "CC0"), (3, "CC0")], "project_id long, license string"),
    }
    monkeypatch.setattr(A, "fx", lambda spark, d, name: frames[name])
    monkeypatch.setattr(tables, "ROWS_PER_TASK", 100)
    return tables.child_tasks(spark, SMALL)


def test_orphan_audit_deals_rows_to_tasks_that_follow_the_size(spark, monkeypatch):
    tasks = _child_frames(spark, monkeypatch)
    assert tasks > spark.sparkContext.defaultParallelism
    out = A.fk_orphans(spark, SMALL)
    assert out._jdf.queryExecution().executedPlan().toString().count(f", {tasks}), REPARTITION_BY_NUM") == 4
    # null is no project, its rows are orphans all the same; a table without orphans has no row
    assert _rows(out) == [("files", 4, 2), ("keywords", 2, 1), ("person_role", 2, 0)]


def test_child_merge_deals_rows_to_tasks_that_follow_the_size(spark, monkeypatch):
    monkeypatch.setattr(tables, "ROWS_PER_TASK", 100)
    tasks, seen, keep = tables.child_tasks(spark, SMALL), [], M.with_ordinal

    def ordinal(df, order, **how):
        seen.append((df._jdf.queryExecution().executedPlan().toString().count(f", {tasks}), REPARTITION_BY_NUM"), how["partitions"]))
        return keep(df, order, **how)

    monkeypatch.setattr(M, "with_ordinal", ordinal)
    out = A.merge_persons(spark, SMALL)
    assert seen == [(1, tasks), (1, tasks)]
    ids = sorted(r.id for r in out.select("id").collect())
    assert ids == list(range(1, len(ids) + 1))


def _odd_visits(spark, n=900):
    """Visits with a hot leading key, null places, paths that come again and rows that come twice."""
    rows = []
    for i in range(n):
        rows.append((None if i % 50 == 0 else 1 if i % 3 else i % 7, None if i % 41 == 0 else i * 37 % 113, f"n{i * 7 % 97}",
                     (i * 13) % 29 if i % 17 else None, "SUCCESS" if i % 4 else "FAILED", None if i % 31 == 0 else i % 9 == 0))
        if i % 20 == 0:
            rows.append(rows[-1])
    return spark.createDataFrame(rows, "a int, b long, name string, size_bytes long, status string, restricted boolean").repartition(5)


def _place(r):
    return tuple((v is not None, v or 0 if not isinstance(v, str) else v) for v in (r["a"], r["b"], r["name"], r["status"], r["size_bytes"]))


def test_cap_without_order_of_all_visits_is_the_running_sum(spark):
    """Two runs over 216 million visits shuffled all of them by place twice, only to tell which are past the cap."""
    df, order = _odd_visits(spark), ["a", "b", "name", "status", "size_bytes"]
    rows = df.collect()
    first = {}
    for r in sorted(rows, key=_place):
        if r["status"] == "SUCCESS" and not r["restricted"]:
            first.setdefault(r["name"], r)
    events = [(_place(r), r["size_bytes"] or 0) for r in first.values()]
    total = sum(b for _, b in events)
    for cap, start in [(total // 2, 0), (total // 2, 5), (1, 0), (total, 0), (total + 1, 0), (10, 10), (0, 0)]:
        want = sorted((_place(r), (used := start + sum(b for e, b in events if e < _place(r))), used >= cap) for r in rows)
        full = admit_by_budget(df, order, ["name"], cap, start)
        assert sorted((_place(r), r["used_before"], r["capped"]) for r in full.collect()) == want
        bare = admit_by_budget(df, order, ["name"], cap, start, used=False)
        assert sorted((_place(r), r["capped"]) for r in bare.collect()) == [(p, c) for p, _, c in want]
        assert sorted(bare.columns) == sorted(set(full.columns) - {"used_before"})
    written = df.cache()
    plan = admit_by_budget(written, order, ["name"], total // 2, used=False)._jdf.queryExecution().optimizedPlan().toString()
    assert not any(step in plan for step in ("Window", "Join", "Aggregate", "Union", "Sort"))


def test_running_sum_shuffles_rows_once(spark):
    """Rows went to a range, to files and to their range's window: two shuffles and a copy on disk."""
    from cataloguer.operators.ordering import cut_points, positions_at

    df, order = _odd_visits(spark), ["a", "b", "name", "status", "size_bytes"]
    out = with_running_sum(df, order, F.col("size_bytes"), exclusive=False, partitions=7)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("shufflepartitionidpassthrough") == 1 and "hashpartitioning" not in plan and "rangepartitioning" not in plan
    assert "Broadcast" not in plan and "ranged-" not in plan
    got, acc = sorted(((_place(r), r["running"]) for r in out.collect())), 0
    for p, running in got:
        acc += p[4][1]
        assert running == acc
    assert 3 <= len(cut_points(df, order, 7)) <= 6 and cut_points(df.where("false"), order, 7) == [] and cut_points(df, order, 1) == []
    ranked = sorted(map(_place, df.collect()))
    places = [1, 2, 400, 401, len(ranked)]
    found = positions_at(df, order, [*places, len(ranked) + 1])
    assert [_place(dict(zip(order, p, strict=True))) for p in found[:-1]] == [ranked[i - 1] for i in places] and found[-1] is None
