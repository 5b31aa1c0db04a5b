"""The pipeline: stages against brute force, awkward rows, and the registered queries against their SQL."""

import duckdb
import pytest

import __spark_entry__ as E
import corpus_pipeline as C
from cataloguer.llm import quality
from cataloguer.llm.decontaminate import LeakParams
from cataloguer.llm.line_dedup import LineParams
from cataloguer.llm.registry import table, written

from ..conftest import SMALL
from .helpers import edge_docs
from .test_dedup import groups, leaks_model, lines_model, quality_model
from .test_tokens import check_pieces, library_ids

OWN = ["op1_token_counts", "op2_packing", "op3_language_id", "op4_chat_formatting", "op5_decontamination", "op6_jaccard_join",
       "op7_line_dedup", "op8_token_files", "op9_suffix_dedup", "op10_quality_rules", "op11_exact_dedup", "op12_hard_negatives", "op13_lexical_search", "pipeline"]
WITH_SQL = ["op4_chat_formatting", "op6_jaccard_join", "op11_exact_dedup", "op12_hard_negatives", "op13_lexical_search"]


def test_all_are_registered():
    assert set(OWN) <= set(E.queries())
    assert {n for n in E.oracle_sql() if n in OWN} == set(WITH_SQL)


@pytest.mark.parametrize("name", WITH_SQL)
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "conversations", "embeddings", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    cur = con.execute(E.oracle_sql()[name])
    names = sorted(c[0] for c in cur.description)
    want = sorted(tuple(dict(zip([c[0] for c in cur.description], r))[n] for n in names) for r in cur.fetchall())
    assert sorted(tuple(r) for r in E.queries()[name](spark, SMALL).select(*names).collect()) == want


def test_stages_equal_brute_force(spark):
    """Each stage on what its predecessor kept."""
    docs = table(spark, SMALL, "documents")
    columns, state = docs.columns, {}
    for name, stage in C.STAGES:
        before = docs.collect()
        docs = written(stage(spark, docs, SMALL), "test")
        state[name] = (before, docs.collect())
        assert name == "packing" or docs.columns == columns
    before, after = state["quality_rules"]
    labels = [tuple(r) for r in table(spark, SMALL, "labels").collect()]
    kept = {r[0] for r in quality_model([tuple(r) for r in before], labels, quality.QualityRules()) if r[-1]}
    assert {r.doc_id for r in after} == kept and {tuple(r) for r in after} <= {tuple(r) for r in before}
    before, after = state["line_dedup"]
    model = lines_model([(r.doc_id, r.text) for r in before], LineParams())
    original = {r.doc_id: r.text for r in before}
    want = {i: t for i, t in model.items() if t == original[i] or t.strip()}
    assert {r.doc_id: r.text for r in after} == want
    assert all(r.n_chars == len(r.text) for r in after if r.text != original[r.doc_id])
    before, after = state["jaccard_join"]
    assert {r.doc_id for r in after} == {root for _, _, root in groups([(r.doc_id, r.text) for r in before], 80, 5)}
    before, after = state["decontamination"]
    items = [(r.item_id, r.text) for r in table(spark, SMALL, "benchmark").collect()]
    assert {r.doc_id for r in before} - {r.doc_id for r in after} == {d for d, _, _ in leaks_model([(r.doc_id, r.text) for r in before], items, LeakParams())}
    before, after = state["packing"]
    check_pieces(after, 2048)
    assert sum(p.length for p in after) == sum(len(library_ids(r.text)) + 1 for r in before)


def test_stages_take_awkward_rows(spark):
    for docs in (edge_docs(spark, ["kept", "n_exact", "first", "component_id", "sequence_id"]), edge_docs(spark).limit(0)):
        columns = docs.columns
        for name, stage in C.STAGES:
            out = stage(spark, docs, SMALL)
            assert name == "packing" or out.columns == columns
            assert out.count() <= docs.count() or name == "packing"


def test_one_of_each_group_stays(spark):
    out = {r.doc_id for r in C.near_duplicates(spark, edge_docs(spark), SMALL).collect()}
    assert {15, 27, 0, 3} <= out and not out & {18, 21, 24, 30}
