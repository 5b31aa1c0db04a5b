"""Plan checks: no Python UDFs, big text never shuffled,
single-partition exchanges only above an aggregate (bounded input)."""

import re

import pytest

import __spark_entry__ as E
from cataloguer.plans import QUERIES

from .conftest import SMALL

NAMES = sorted(QUERIES)
TEXT_COLS = re.compile(r"\b(html|text|json|xml)#")


def formatted(spark, df):
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


def sections(plan):
    out = {}
    parts = re.split(r"\n\((\d+)\) ", plan)
    for i in range(1, len(parts) - 1, 2):
        out[int(parts[i])] = parts[i + 1]
    return out


def tree_nodes(plan):
    """(depth, name, id) of the indented operator tree at the top of a formatted plan."""
    nodes = []
    for line in plan.split("\n\n")[0].split("\n"):
        m = re.search(r"^([\s:|+\-]*?)([A-Za-z][\w ]*?) \((\d+)\)", line)
        if m:
            nodes.append((len(m.group(1)), m.group(2).strip(), int(m.group(3))))
    return nodes


def first_source_below(nodes, oid):
    """The first aggregate or scan met in the subtree of operator ``oid`` (pre-order)."""
    idx = next(i for i, n in enumerate(nodes) if n[2] == oid)
    depth = nodes[idx][0]
    for d2, name, _ in nodes[idx + 1:]:
        if d2 <= depth:
            break
        if "Aggregate" in name or "Scan" in name or "LocalTableScan" in name:
            return name
    return ""


@pytest.fixture(scope="module")
def plans(spark):
    qs = E.queries()
    return {n: formatted(spark, qs[n](spark, SMALL)) for n in NAMES}


def test_no_python_in_plans(plans):
    for n, p in plans.items():
        assert not re.search(r"EvalPython|InPandas|PythonUDF|MapInArrow", p), n


def test_text_columns_never_shuffled(plans):
    for n, p in plans.items():
        for oid, sec in sections(p).items():
            if sec.startswith("Exchange") or sec.startswith("BroadcastExchange"):
                first = sec.split("\n")[1] if "\n" in sec else ""
                assert not TEXT_COLS.search(first), f"{n}: exchange ({oid}) carries {first[:120]}"


def test_single_partition_only_above_aggregates(plans):
    for n, p in plans.items():
        secs = sections(p)
        nodes = tree_nodes(p)
        for oid, sec in secs.items():
            if sec.startswith("Exchange") and "SinglePartition" in sec:
                src = first_source_below(nodes, oid)
                assert "Aggregate" in src, f"{n}: SinglePartition exchange ({oid}) over {src}"


def test_scans_prune_columns(plans):
    # projects_full reads 5 of the 9 lineitem columns at most
    rs = re.findall(r"ReadSchema: struct<(l_[^>]*)>", plans["projects_full"])
    assert rs and all(len(x.split(",")) <= 6 for x in rs)


def test_exports_are_compressed(spark):
    """Six tables as plain text took 2.1 GB of disk for 83 MB of input."""
    from cataloguer.plans.export import read_csv, write_csv
    from cataloguer.session import scratch_path

    rows = spark.createDataFrame([(1, 'a "b"\nc'), (2, None)], "id long, x string")
    path = scratch_path(spark, "t-export")
    write_csv(rows, path)
    back = read_csv(spark, path, rows.schema)
    assert all(f.endswith(".csv.gz") for f in back.inputFiles())
    assert sorted(map(tuple, back.collect())) == [(1, 'a "b"\nc'), (2, None)]


def test_landed_pages_are_parsed_once(spark):
    """Pages are many small files: the result reads parsed rows, not the pages once more for the first broken one."""
    files = E.queries()["src_landed_oai_pages"](spark, SMALL).inputFiles()
    assert files and all("/landed-oai-rows-" in f for f in files)


def test_both_runs_are_folded_once(spark):
    """The result reads the two folded runs; nothing of them is worked out again."""
    df = E.queries()["two_run_status"](spark, SMALL)
    assert {re.search("/([a-z-]+-run-status)-", f).group(1) for f in df.inputFiles()} == {"first-run-status", "second-run-status"}
    assert "Aggregate" not in df._jdf.queryExecution().toString()


def test_flat_export_runs_its_joins_once(plans):
    """Spark's own order samples the joined rows, so all joins of 18 million rows ran twice; the files took two shuffles."""
    exchanges = [s for s in sections(plans["projects_full"]).values() if s.startswith("Exchange")]
    assert not any("rangepartitioning" in s for s in exchanges)
    assert not any("hashpartitioning(project_id" in s and "file_name" in s.partition("hashpartitioning")[2].partition(")")[0] for s in exchanges)


def test_order_by_ranges_is_the_order(spark):
    """Same rows in the same order as orderBy, with null and repeated ids, for any bounds."""
    from pyspark.sql import functions as F

    from cataloguer.operators.ordering import order_by_ranges, range_bounds

    rows = [(None, "b"), (None, None), *[(i % 37, f"f{i * 7 % 50}") for i in range(300)], *[(5, f"g{i}") for i in range(200)], (-3, None), (10**12, "z")]
    df = spark.createDataFrame(rows, "id long, name string").repartition(5)
    order = [F.col("id").asc(), F.col("name").asc_nulls_first()]
    want = [tuple(r) for r in df.orderBy(*order).collect()]
    bounds = range_bounds(df, "id", 8)
    assert bounds == sorted(set(bounds)) and len(bounds) > 3
    for b in (bounds, [], [5], [-10, 10**13]):
        assert [tuple(r) for r in order_by_ranges(df, "id", b, order).collect()] == want
    assert range_bounds(df.where("false"), "id", 8) == [] and range_bounds(df, "id", 1) == []
    assert [tuple(r) for r in order_by_ranges(df.where("false"), "id", [], order).collect()] == []
