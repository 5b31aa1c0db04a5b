"""Micro-batches: repeatable writes, pruned archive reads, payloads that are no JSON."""

import pytest
from pyspark.sql import functions as F

from cataloguer import rules
from cataloguer.operators.merge import merge_into, new_rows
from cataloguer.plans.archive import select_source
from cataloguer.session import scratch_path
from cataloguer.sources import dataverse as DV
from cataloguer.sources.store import BUCKET, append_bucketed, highest_id, read_buckets, read_rows
from cataloguer.streaming.batchlog import latest, read_batches, write_batch
from cataloguer.streaming.visits import VisitStream, status_rows, statuses

from .conftest import SMALL

VISIT = "seq long, name string, restricted boolean, outcome string, on_disk boolean, size_bytes long"
OK, NO = rules.SUCCESS, rules.FAILED


def visits(spark, rows):
    return spark.createDataFrame([(s, n, r, o, False, b) for s, n, r, o, b in rows], VISIT)


def state(spark, stream):
    fold = status_rows(visits(spark, []), stream.key, stream.order).schema
    return {r["name"]: r["status"] for r in statuses(spark, stream.base, fold, stream.key).collect()}


def used(spark, stream):
    return [(r["seq"], r["used_before"], r["budget_status"]) for r in read_batches(spark, stream.base, "visits", VISIT).orderBy("seq").collect()]


def test_running_total_passes_between_batches_and_replays_change_nothing(spark):
    stream = VisitStream(scratch_path(spark, "t"), ["name"], ["seq"], cap_bytes=100)
    one = visits(spark, [(1, "a", False, OK, 60), (2, "b", False, NO, 500), (3, "a", False, OK, 60), (4, "r", True, None, 9)])
    two = visits(spark, [(5, "a", False, OK, 60), (6, "c", False, OK, 50), (7, "d", False, OK, 1), (8, "r", False, OK, 1), (9, "b", True, None, 1)])
    three = visits(spark, [(10, "b", False, OK, 7)])
    for _ in range(2):  # the batch is replayed before it is committed
        stream.admit(one, 0)
    stream.admit(two, 1)
    before = used(spark, stream), state(spark, stream)
    stream.admit(two, 1)
    assert (used(spark, stream), state(spark, stream)) == before
    stream.admit(three, 2)
    # c crosses the cap and is still taken; what comes after is skipped
    assert [u for _, u, _ in used(spark, stream)] == [0, 60, 60, 60, 60, 60, 110, 111, 112, 112]
    assert state(spark, stream) == {"a": OK, "b": rules.SKIPPED, "c": OK, "d": rules.SKIPPED, "r": rules.SKIPPED}


def test_a_later_batch_wins(spark):
    base = scratch_path(spark, "t")
    for batch, value in [(0, "x"), (1, "y"), (0, "z")]:
        write_batch(spark.createDataFrame([("k", value)], "k string, v string"), base, "s", batch)
    rows = read_batches(spark, base, "s", "k string, v string")
    assert [r["value"] for r in latest(rows, ["k"], F.col("v")).collect()] == ["y"]
    assert [r["v"] for r in read_batches(spark, base, "s", "k string, v string", before=1).collect()] == ["z"]
    assert read_batches(spark, base, "none", "k string").count() == 0


def test_merges_read_the_buckets_they_touch(spark):
    base, key = scratch_path(spark, "t"), ["k"]
    archive = None
    for lo, hi in [(0, 60), (40, 80), (10, 12), (5, 5)]:
        batch = spark.range(lo, hi).select(F.col("id").cast("string").alias("k"), F.lit(lo).alias("n"))
        there = read_buckets(spark, base, "t", batch, key, 8)
        append_bucketed(new_rows(there, batch, key, ["n", "k"], columns=["k", "n"], last_id=highest_id(spark, base, "t")), base, "t", key, 8)
        archive = merge_into(archive, batch, key, ["n", "k"], columns=["k", "n"])
        if hi == 12:
            plan = read_buckets(spark, base, "t", batch, key, 8)._jdf.queryExecution().executedPlan().toString()
            assert f"{BUCKET}#" in plan.split("PartitionFilters: [")[1].split("]")[0]
            assert read_buckets(spark, base, "t", batch, key, 8).count() < read_rows(spark, base, "t").count()
    got = read_rows(spark, base, "t").drop(BUCKET)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, archive.select("id", "k", "n").collect()))


@pytest.mark.parametrize("source, folders", [("uni_halle", 1), ("both", 2)])
def test_source_choice_opens_one_folder(spark, source, folders):
    df = select_source(spark, SMALL, source)
    assert len({f.split("source=")[1].split("/")[0] for f in df.inputFiles()}) == 2
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert ("source#" in plan.split("PartitionFilters: [")[1].split("]")[0]) == (folders == 1)


def test_a_payload_that_is_no_json_costs_one_dataset(spark):
    rows = [(1, '{"data":{"latestVersion":{"versionNumber":2,"versionMinorNumber":1,"files":[{"dataFile":{"id":7}}]}}}'),
            (2, "<html>502 Bad Gateway</html>"), (3, ""), (4, None), (5, '{"data":'), (6, "[1]")]
    out = DV.parse_details(spark.createDataFrame(rows, "ds int, json string"), keep=["ds"])
    assert [r.ds for r in out.where(F.size("files") > 0).collect()] == [1]
    assert out.count() == 6


def test_parts_land_by_many_tasks_and_are_one_micro_batch_each(spark):
    from cataloguer.plans import reports as R
    from cataloguer.plans.streams import drained

    n = 3000
    rows = spark.range(n).select(
        (F.col("id") % 4).cast("int").alias("station_ord"), F.col("id").alias("ord1"), F.col("id").alias("ord2"), (F.col("id") % 5).alias("project_id"),
        F.concat(F.lit("f"), F.col("id") % 500).alias("file_name"), F.lit(False).alias("restricted"), F.lit(OK).alias("status"), F.lit(1).cast("long").alias("size_bytes"),
    ).withColumn("outcome", F.col("status")).withColumn("on_disk", F.lit(False))
    stream = VisitStream(scratch_path(spark, "t"), R.KEY_FILE, R.WORK_ORDER, cap_bytes=1 << 40)
    drained(stream, spark, rows, 3)
    assert stream.done == [0, 1, 2, 2]  # one micro-batch a part, the last one replayed
    assert len(spark.read.parquet(f"{stream.base}/landing").inputFiles()) > 3  # no part is a single task's
    out = read_batches(spark, stream.base, "visits", rows.schema)
    assert {r["batch"]: r["count"] for r in out.groupBy("batch").count().collect()} == {0: 1001, 1: 1001, 2: 998}
    assert out.agg(F.max("used_before")).first()[0] == rows.select("project_id", "file_name").distinct().count()


def test_status_rows_hold_their_key_once(spark):
    """A position repeated the path that is the row's key: a status row shuffled it three times and kept it three times."""
    order = ["seq", "name"]
    rows = visits(spark, [(2, "a", False, OK, 1), (1, "a", True, None, 1), (3, "a", False, None, 1), (5, "b", True, OK, 1), (4, None, False, NO, 1)])
    out = status_rows(rows, ["name"], order)
    assert "name" not in out.schema["first"].dataType.names + out.schema["last"].dataType.names
    got = {r["name"]: (r["first"]["_to"], r["last"] and r["last"]["_to"]) for r in out.collect()}
    assert got == {"a": (rules.RESTRICTED, OK), "b": (rules.RESTRICTED, None), None: (rules.SKIPPED, NO)}
    base = scratch_path(spark, "t")
    for n, some in enumerate([rows, visits(spark, [(1, "a", False, NO, 1), (9, "b", False, None, 1), (1, "c", False, None, 1)])]):
        write_batch(status_rows(some, ["name"], order), base, "statuses", n)
    folded = {r["name"]: r["status"] for r in statuses(spark, base, out.schema, ["name"]).collect()}
    assert folded == {"a": NO, "b": rules.RESTRICTED, "c": rules.SKIPPED, None: NO}


def test_a_stream_without_running_bytes_caps_the_same_visits(spark):
    rows = [(i, f"n{i * 7 % 23}", i % 9 == 0, OK if i % 3 else NO, 5 + i % 4) for i in range(90)]
    states, capped = [], []
    for full in (True, False):
        stream = VisitStream(scratch_path(spark, "t"), ["name"], ["seq"], cap_bytes=70, used=full)
        for n in range(3):
            stream.admit(visits(spark, rows[n * 30:n * 30 + 30]), n)
        stream.admit(visits(spark, rows[60:]), 2)
        out = read_batches(spark, stream.base, "visits", VISIT)
        assert ("used_before" in out.columns) == full
        capped.append(sorted((r["seq"], r["capped"], r["outcome"], r["budget_status"]) for r in out.collect()))
        states.append(state(spark, stream))
    assert states[0] == states[1] and capped[0] == capped[1]
    assert {c for _, c, _, _ in capped[0]} == {True, False}
