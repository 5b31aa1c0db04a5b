"""Exact dedup, hard negatives and lexical search against brute force."""

import collections
import hashlib
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from cataloguer.llm import exact_dedup as X
from cataloguer.llm import hard_negatives as H
from cataloguer.llm import lexical_search as S

from .helpers import FOLD, SCHEMA, edge_docs, edge_rows, rows_of

RUN = re.compile("[\x20\x09-\x0d]+")
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
SMALL_CHUNKS = X.RecipeParams(min_chunk=32, max_chunk=128, cut_bits=5)


# exact dedup

def groups(rows):
    """(doc_id, keep_id, group_size, kept, sha) of (doc_id, text) rows."""
    texts = [RUN.sub(" ", t or "") for _, t in rows]
    members = collections.defaultdict(list)
    for k, t in enumerate(texts):
        members[t].append(k)
    keep = {t: min(ks, key=lambda k: (rows[k][0] is None, rows[k][0] or 0, k)) for t, ks in members.items()}
    return sorted(((rows[k][0], rows[keep[t]][0], len(members[t]), k == keep[t], hashlib.sha256(t.encode()).hexdigest())
                   for k, t in enumerate(texts)), key=repr)


def found_groups(df, params):
    return rows_of(X.exact_dedup(df, params), "doc_id", "keep_id", "group_size", "kept", "text_sha256")


def copies(seed, n):
    """Long texts whose parts are shared, shuffled or repeated, some as exact copies but for white space."""
    rng = random.Random(seed)
    parts = ["".join(rng.choice("abcdefgh \n\t") for _ in range(rng.choice([5, 40, 200, 900]))) for _ in range(12)]
    out = []
    for _ in range(n):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 6)))
        out += [text, text.replace(" ", " \x0b\r"), text + " "][: rng.randint(1, 3)]
    return [(rng.randrange(10**6) if rng.random() < 0.9 else None, t) for t in out]


@pytest.mark.parametrize("params", [X.RecipeParams(), SMALL_CHUNKS, X.RecipeParams(min_chunk=32, max_chunk=128, cut_bits=5, memo_bytes=0, salts=2)])
def test_exact_dedup_equals_brute_force(spark, params):
    rows = copies(3, 120)
    assert found_groups(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), params) == groups(rows)


def test_exact_dedup_takes_awkward_rows(spark):
    rows = [r[:2] for r in edge_rows()]
    assert found_groups(edge_docs(spark, ["recipe", "kept", "salt", "digest"]), X.RecipeParams()) == groups(rows)
    assert found_groups(edge_docs(spark).limit(0), X.RecipeParams()) == []
    left = X.first_copies(edge_docs(spark, ["kept"])).collect()
    assert {r.doc_id for r in left} == {r[0] for r in groups(rows) if r[3]} and len(left[0]) == 6


def test_colliding_digests_are_made_wider(spark):
    """Identifiers of one byte collide for sure; the result is the same."""
    rows = [(k, f"text number {k} " * 20) for k in range(400)] + [(1000 + k, f"text number {k} " * 20) for k in range(0, 400, 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    tiny = X.RecipeParams(digest_bytes=1)
    assert X.collisions(X.chunks(df.select("text"), 1, tiny)).count() > 0
    assert X.collisions(X.chunks(df.select("text"), 16, tiny)).count() == 0
    assert found_groups(df, tiny) == groups(rows)


def test_cuts_follow_the_content():
    rng = np.random.default_rng(1)
    text = rng.integers(97, 123, 60_000).astype(np.uint8).tobytes()
    import pyarrow as pa

    p = X.RecipeParams()
    (_, one), (_, two) = X.cut_texts(pa.array([text.decode(), "zz" + text.decode()]), p)
    a, b = X._pieces(text, one), X._pieces(b"zz" + text, two)
    assert b"".join(a) == text and max(map(len, a)) <= p.max_chunk and min(map(len, a[:-1])) >= p.min_chunk
    assert len(set(a) & set(b)) >= len(a) - 2
    assert X.cuts([], 40_000, p) == [16_384, 32_768, 40_000] and X.cuts([], 0, p) == []


def test_hot_group_is_salted(spark):
    df = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "one text").otherwise(F.col("id").cast("string")).alias("text"))
    out = X.exact_dedup(df)
    assert out.where("group_size = 1000").count() == 1000 and out.where("kept").count() == 2001
    assert out.where("kept and group_size = 1000").first().doc_id == 0


# hard negatives

def mined(rows, p):
    usable = [(i, lab, [math.floor(p.scale * x) for x in v]) for i, lab, v in rows
              if i is not None and lab is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    anchors = {}
    for r in sorted(usable, key=lambda r: (r[0], r[1])):
        if r[0] % p.anchor_every == 0:
            anchors.setdefault(r[0], r)
    out = []
    for i, lab, v in anchors.values():
        seen = sorted({(-sum(a * b for a, b in zip(v, w)), j, m == lab) for j, m, w in usable if j != i or m != lab})
        for ps, pid, same in [x for x in seen if x[2] and x[1] != i][: p.positives]:
            bad = [(j, s) for s, j, other in seen if not other and p.low_percent * -ps <= 100 * -s <= p.high_percent * -ps]
            out += [(i, pid, n + 1, j, -ps, -s) for n, (j, s) in enumerate(bad[: p.negatives])]
    return sorted(out, key=repr)


def vectors(seed, n, dim, spread=0.15):
    rng = np.random.default_rng(seed)
    middle = rng.standard_normal((6, dim)) / math.sqrt(dim)
    out = []
    for i in range(n):
        lab = int(rng.integers(6))
        at = middle[lab] if rng.random() < 0.8 else middle[int(rng.integers(6))]
        out.append((i, lab, [float(np.float32(x)) for x in at + spread * rng.standard_normal(dim) / math.sqrt(dim) + middle[0]]))
    return out


VECTORS = "vec_id long, label int, embedding array<float>"


@pytest.mark.parametrize("dim,block", [(64, 1 << 24), (70, 6000), (3, 200), (1, 1 << 20)])
def test_hard_negatives_equal_brute_force(spark, dim, block):
    """Also with several blocks, small batches and dimensions that fill no whole word."""
    rows, p = vectors(dim, 900, dim), H.MiningParams(block_bytes=block, batch_rows=100, batch_anchors=5)
    df = spark.createDataFrame(rows, VECTORS).repartition(4)
    assert rows_of(H.hard_negatives(df, p), "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score") == mined(rows, p)


def test_hard_negatives_take_awkward_rows(spark):
    rows = vectors(5, 300, 16)
    one = rows[7][2]
    rows += [(None, 1, one), (1000, None, one), (1001, 2, None), (1002, 2, [None, *one[1:]]), (1003, 2, [float("nan"), *one[1:]]),
             (1004, 2, [float("inf"), *one[1:]]), rows[7], rows[7], rows[50], (2000, 3, [0.0] * 16), (-50, 2, one)]
    rows += [(3000 + k, k % 2, one) for k in range(200)]  # ties
    p = H.MiningParams()
    df = spark.createDataFrame(rows, VECTORS).select("*", F.lit("x").alias("slot"), F.lit("y").alias("score"))
    got = rows_of(H.hard_negatives(df, p), "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    assert got == mined(rows, p) and len(got) > 50
    assert H.hard_negatives(df.limit(0)).count() == 0
    short = spark.createDataFrame([(0, 1, []), (1, 1, [1.0]), (2, 2, [1.0, 2.0])], VECTORS)
    assert H.hard_negatives(short).count() == 1  # all scores are 0


def test_scores_lie_in_their_intervals():
    rng = np.random.default_rng(4)
    for dim in (1, 5, 64, 130):
        p = H.MiningParams(query_bits=4)
        x, q = np.floor(256 * rng.standard_normal((300, dim))), np.floor(256 * rng.standard_normal((40, dim)))
        q[0], x[:40] = 0, q + np.rint(rng.standard_normal(q.shape))
        least, most = H.Queries(q, p).intervals(slice(0, 40), *H.encode(x, p.seed))
        score = x @ q.T
        assert (least <= score).all() and (score <= most).all()
        if dim > 60:  # each anchor has a near copy, which leaves most others out
            assert (most < score.max(axis=0)).mean() > 0.5


def test_whole_scores_beyond_floats():
    big = np.array([[2.0**40, 3.0], [2.0**31, 1.0]])
    assert H.whole_scores(big, big).tolist() == [(1 << 63) - 1, (1 << 62) + 1]


# lexical search

def searched(docs, items, top=50):
    terms = [collections.Counter(TERM.findall((t or "").translate(FOLD))) for _, t in docs]
    n_docs, n_all = sum(map(bool, terms)), sum(sum(t.values()) for t in terms)
    df = collections.Counter(t for c in terms for t in c)
    of_item = collections.defaultdict(set)
    for i, t in items:
        if i is not None:
            of_item[i] |= set(TERM.findall((t or "").translate(FOLD)))
    out = []
    for i, wanted in of_item.items():
        found = []
        for (doc_id, _), c in zip(docs, terms):
            if not c:
                continue
            m = 100 - 50 + (50 * sum(c.values()) * n_docs) // n_all
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m)) for t in wanted & set(c))
            if s > 0:
                found.append((-s, doc_id is None, doc_id))
        found.sort(key=lambda x: (x[0], x[1], x[2] or 0))
        out += [(i, k + 1, d, -s) for k, (s, _, d) in enumerate(found[:top])]
    return sorted(out, key=repr)


def corpus(seed, n):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + ["Wört", "日本", "a", "A", "x\x85y", "é\xa0b", "0", "ab", "abc", "bc"]
    text = lambda k: "".join(rng.choice(words) + rng.choice([" ", " ", "-", "\n", "", "''", "\x00"]) for _ in range(k))
    return [(rng.randrange(10**6), text(rng.choice([0, 1, 5, 40, 300]))) for _ in range(n)], [(i, text(rng.choice([1, 3, 20]))) for i in range(25)]


@pytest.mark.parametrize("params", [S.SearchParams(), S.SearchParams(top=7, block_bytes=300, batch_docs=9, batch_items=4, batch_terms=5)])
def test_search_equals_brute_force(spark, params):
    """Also with several blocks, and matrices cut in small parts."""
    docs, items = corpus(2, 400)
    out = S.ranked_search(spark.createDataFrame(docs, "doc_id long, text string").repartition(5), spark.createDataFrame(items, "item_id long, text string"), params)
    assert rows_of(out, "item_id", "rank", "doc_id", "score") == searched(docs, items, params.top)


def test_search_takes_awkward_rows(spark):
    docs = [r[:2] for r in edge_rows()]
    items = [(1, "Three FIVE w3x3"), (1, "seven"), (2, None), (None, "one"), (3, ""), (4, "日本語 word"), (5, "?!")]
    items_df = spark.createDataFrame(items, "item_id long, text string").select("*", F.lit(1).alias("term"))
    clash = edge_docs(spark, ["n", "terms", "item_id", "rank"])
    assert rows_of(S.ranked_search(clash, items_df), "item_id", "rank", "doc_id", "score") == searched(docs, items)
    assert S.ranked_search(clash.limit(0), items_df).count() == 0
    assert S.ranked_search(clash, items_df.limit(0)).count() == 0


def test_search_sums_beyond_floats_in_integers(spark):
    """A document that could leave the exact range of float64 is summed in 64-bit integers."""
    words = [f"q{i}" for i in range(40)]
    docs = [(k, " ".join(words[: k + 1])) for k in range(40)]
    items = [(0, " ".join(words))]
    exact = S._EXACT
    try:
        S._EXACT = 2
        out = S.ranked_search(spark.createDataFrame(docs, SCHEMA.split(", lang")[0]), spark.createDataFrame(items, "item_id long, text string"))
        assert rows_of(out, "item_id", "rank", "doc_id", "score") == searched(docs, items)
    finally:
        S._EXACT = exact
