"""Jaccard join, line dedup, suffix-array dedup, quality rules and decontamination against brute force."""

import collections
import hashlib
import math
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from cataloguer.llm import components, decontaminate, jaccard_join, line_dedup, quality, sais, suffix_dedup
from cataloguer.llm.queries import op10_quality_rules

from ..conftest import MEDIUM, SMALL
from .helpers import FOLD, SCHEMA, WORD, edge_docs, edge_rows, rows_of


def shingles(text, k):
    w = WORD.findall((text or "").translate(FOLD))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()


def groups(rows, percent, k):
    """component of each doc_id by comparing everything."""
    sets = {i: shingles(t, k) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return sorted((i, len(sets[i]), find(i)) for i in ids)


def variants(seed, n):
    """Families of texts around the link threshold, of many sizes, with shared lines."""
    rng = random.Random(seed)
    words = [f"v{i}" for i in range(300)]
    out = []
    for family in range(n):
        base = [rng.choice(words) for _ in range(rng.choice([5, 8, 12, 20, 40, 90, 200]))]
        for _ in range(rng.randint(1, 9)):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 6])):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            if rng.random() < 0.3:
                copy += [rng.choice(words) for _ in range(rng.randint(1, 4))]
            if rng.random() < 0.5:
                copy += "a line that very many of the documents share in full".split()
            out.append(" ".join(copy))
    rng.shuffle(out)
    return list(enumerate(out))


@pytest.mark.parametrize("params", [jaccard_join.JaccardParams(), jaccard_join.JaccardParams(percent=80, words=5, weak=1), jaccard_join.JaccardParams(percent=60, growth=2.0, seeds=1)])
def test_jaccard_join_equals_brute_force(spark, params):
    rows = variants(4, 60)
    got = rows_of(jaccard_join.jaccard_join(spark.createDataFrame(rows, "doc_id long, text string"), params), "doc_id", "n_shingles", "component_id")
    assert sorted(got) == groups(rows, params.percent, params.words)


def test_jaccard_edges(spark):
    out = jaccard_join.jaccard_join(edge_docs(spark, ["n", "cls", "key", "keys"])).collect()
    assert len(out) == len(edge_rows())
    by_id = {r.doc_id: r for r in out if r.doc_id not in (None, 15)}
    assert by_id[0].n_shingles == 0 and by_id[0].component_id == 0 and by_id[6].component_id == 6
    assert by_id[9].n_shingles == 1 and by_id[12].n_shingles == 1
    assert by_id[18].component_id == by_id[21].component_id == by_id[24].component_id == 15  # upper case, equal, one word more
    assert by_id[30].component_id == 27
    assert jaccard_join.jaccard_join(spark.createDataFrame([], SCHEMA)).count() == 0


def test_linked_sets_share_a_region():
    """The pigeonhole argument on random pairs right at the threshold."""
    rng = np.random.default_rng(2)
    windows = jaccard_join.Windows(jaccard_join.JaccardParams())
    for n in [6, 7, 12, 13, 18, 25, 40, 77, 150, 400]:
        for _ in range(40):
            x = rng.integers(0, 2**63, n).astype(np.uint64)
            fewer = int(rng.integers(0, n * 15 // 185 + 1))
            y = np.concatenate([x[fewer:], rng.integers(0, 2**63, fewer).astype(np.uint64)])
            common = len(np.intersect1d(x, y))
            if fewer and 100 * common >= 85 * (2 * n - common):
                a, b = (jaccard_join.slice_keys(np.unique(v), windows, 8) for v in (x, y))
                assert len(np.intersect1d(a, b)), n


def test_components(spark):
    rng = random.Random(1)
    links = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(1000 + i, 1001 + i) for i in range(40)] + [(5000, 5001 + i) for i in range(50)]
    got = dict(rows_of(components.components(spark.createDataFrame(links, "u long, v long")), "node", "root"))
    root = {x: x for p in links for x in p}
    for _ in range(100):
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    assert got == {x: r for x, r in root.items() if any(x in p and p[0] != p[1] for p in links)}


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def lines_model(rows, p):
    seen, out = [], {}
    for i, t in sorted(rows):
        kept = []
        for line in t.split("\n"):
            if len(line) < p.min_exact or not line.strip(" \t\n\x0b\x0c\r"):
                kept.append(line)
                continue
            near = len(line) >= p.min_near and any(
                abs(len(line) - len(x)) <= p.max_edits and len(x) >= p.min_near and edits(line, x) <= p.max_edits for x in seen)
            if line not in seen:
                seen.append(line)
                if not near:
                    kept.append(line)
        out[i] = "\n".join(kept)
    return out


@pytest.mark.parametrize("params", [line_dedup.LineParams(min_exact=5, min_near=9), line_dedup.LineParams(min_exact=3, min_near=9, cell=1), line_dedup.LineParams(max_edits=1, min_exact=5, min_near=8), line_dedup.LineParams(min_exact=3, min_near=9, cell=3, deep=3)])
def test_lines_equal_brute_force(spark, params):
    rng = random.Random(8)
    pool = ["".join(rng.choice("ab cé😀") for _ in range(rng.randint(4, 30))) for _ in range(25)]
    rows = []
    for i in range(60):
        lines = []
        for _ in range(rng.randint(0, 5)):
            line = list(rng.choice(pool))
            for _ in range(rng.choice([0, 0, 1, 2, 3])):
                k = rng.randrange(len(line) + 1)
                line[k : k + rng.choice([0, 1])] = rng.choice(["", "x", "b"])
            lines.append("".join(line))
        rows.append((i, "\n".join(lines)))
    got = dict(rows_of(line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"), params), "doc_id", "text"))
    assert got == lines_model(rows, params)


@pytest.mark.parametrize("k", [1, 2, 4])
def test_bit_parallel_distance(spark, k):
    rng = random.Random(k)
    rows = []
    for _ in range(600):
        a = [rng.choice("abé😀") for _ in range(rng.randint(0, 15))]
        b = list(a)
        for _ in range(rng.randint(0, k + 2)):
            at = rng.randint(0, len(b))
            b[at : at + rng.choice([0, 1])] = rng.choice(["", "a", "b"])
        rows.append(("".join(a), "".join(b)))
    df = spark.createDataFrame(rows, "a string, b string")
    assert df.where(~line_dedup.within_edits(F.col("a"), F.col("b"), k).eqNullSafe(F.levenshtein("a", "b") <= k)).count() == 0


def test_line_edges(spark):
    names = ["n_lines", "th", "line_no", "h1", "first", "_lines", "_row"]
    out = line_dedup.dedup_lines(edge_docs(spark, names))
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", *names[1:], "n_lines", "n_exact", "n_near"]
    rows = out.collect()
    assert len(rows) == len(edge_rows())
    by_id = {r.doc_id: r for r in rows if r.doc_id not in (None, 15)}
    assert by_id[0].text is None and by_id[3].text == "" and by_id[6].text == "   \n\t "
    assert by_id[33].text == "line one is long enough to count as text\n" and by_id[33].n_exact == 3
    assert by_id[21].text == "" and by_id[18].text == edge_rows()[6][1]  # equal text goes, other case stays
    assert line_dedup.dedup_lines(spark.createDataFrame([], SCHEMA)).count() == 0


def suffix_model(rows, window):
    seen, out = set(), {}
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        b = (t or "").encode()
        covered = bytearray(len(b))
        for k in range(len(b) - window + 1):
            if b[k : k + window] in seen:
                covered[k : k + window] = b"\1" * window
            seen.add(b[k : k + window])
        kept = bytes(c for c, f in zip(b, covered) if not f)
        runs = sum(1 for k in range(len(b)) if covered[k] and (not k or not covered[k - 1]))
        out[i] = (len(b), len(b) - len(kept), runs, hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("hot", [2000, 1])
def test_suffix_dedup_equals_brute_force(spark, hot):
    rng = random.Random(11)
    words = [w for w in ("na", "ti", "on", "er", "éa", "the", "日") for _ in range(2)]
    text = lambda n: " ".join(rng.choice(words) + rng.choice(words) for _ in range(n))
    passages = [text(rng.randint(10, 60)) for _ in range(6)]
    rows = []
    for i in range(70):
        parts = [rng.choice([text(rng.randint(0, 30)), rng.choice(passages), rng.choice(passages)[3:-5]]) for _ in range(rng.randint(0, 4))]
        rows.append((i, "".join(parts)))
    rows += [(100, rows[3][1]), (101, "ab" * 300), (102, "x" * 99), (103, "x" * 100), (104, "x" * 101), (105, None), (106, "")]
    out = suffix_dedup.suffix_dedup(spark.createDataFrame(rows, "doc_id long, text string"), suffix_dedup.SuffixParams(hot=hot)).collect()
    got = {r.doc_id: (r.n_bytes, r.n_bytes - len(r.kept), len(r.spans), hashlib.sha256(r.kept).hexdigest()) for r in out}
    assert got == suffix_model(rows, 100)


def test_suffix_edges(spark):
    out = suffix_dedup.suffix_dedup(edge_docs(spark, ["rank", "lo", "ranges"])).collect()
    assert len(out) == len(edge_rows())
    rows = [r for r in edge_rows() if r[0] != 15 and r[0] is not None]
    first = [(None, t) for d, t, *_ in edge_rows() if d is None] + [(15, edge_rows()[5][1])]
    want = suffix_model([(-2, first[0][1]), (-1, first[1][1])] + [(d, t) for d, t, *_ in rows] + [(14.5, edge_rows()[18][1]), (15, first[2][1])], 100)
    for r in out:
        if r.doc_id not in (None, 15):
            assert (r.n_bytes, r.n_bytes - len(r.kept)) == want[r.doc_id][:2], r.doc_id
    assert suffix_dedup.suffix_dedup(spark.createDataFrame([], SCHEMA)).count() == 0


def test_suffix_arrays():
    rng = random.Random(3)
    for _ in range(500):
        v = [rng.randint(0, rng.choice([0, 1, 3, 25])) for _ in range(rng.randint(0, 50))]
        want = sorted(range(len(v)), key=lambda i: v[i:])
        assert sais.suffix_array(np.array(v, np.int64)).tolist() == want
        if len(v) > 1:
            lcp = sais.permuted_lcp(np.array(v), np.array(want), np.full(len(v), len(v)), 5)
            for a, b in zip(want, want[1:]):
                h = 0
                while h < 5 and max(a, b) + h < len(v) and v[a + h] == v[b + h]:
                    h += 1
                assert lcp[b] == h


def quality_model(rows, labels, p):
    """Contract counts and verdicts."""
    def bucket(w):
        h = xxhash.xxh64_intdigest(w.lower().encode(), seed=42)  # the engine's hash is a signed number
        return (h - (1 << 64) if h >= 1 << 63 else h) % p.buckets

    raw, good = collections.Counter(), collections.Counter()
    state = collections.defaultdict(lambda: True)
    for d, q, t in labels:
        state[d] &= q == 1 and not t
    for d, text, *_ in rows:
        for w in WORD.findall(text or ""):
            b = bucket(w)
            raw[b] += 1
            good[b] += d is not None and d in state and state[d]
    nr, ng = sum(raw.values()), sum(good.values())
    weight = {}
    for b, c in raw.items():
        w = math.log((good[b] + p.smoothing) / (c * ng / nr + p.smoothing)) if ng else 0
        weight[b] = round(w * quality.MICRO) if w < -p.dead_zone else 0
    out = []
    for d, text, *_ in rows:
        text = text or ""
        words = WORD.findall(text)
        lines = [x for x in text.split("\n") if WORD.search(x)]
        spots = collections.defaultdict(list)
        for i in range(len(words) - 2):
            spots[tuple(words[i : i + 3])].append(i)
        repeat = len({j for v in spots.values() if len(v) > 1 for i in v for j in (i, i + 1, i + 2)})
        failed = len(words) < p.min_words or 100 * repeat > p.max_repeat_percent * len(words)
        total = sum(weight[bucket(w)] for w in words)
        kept = not failed and total >= round(p.threshold * quality.MICRO) * len(words)
        out.append((d, len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), repeat, failed, kept))
    return sorted(out, key=repr)


COLUMNS = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]


def test_quality_equals_brute_force(spark):
    docs, labels = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "labels"))
    p = quality.QualityRules(smoothing=3.0)
    got = rows_of(quality.quality_rules(docs, labels, p), *COLUMNS)
    want = quality_model([tuple(r) for r in docs.collect()], [tuple(r) for r in labels.collect()], p)
    assert got == want
    assert len({r[-1] for r in want if not r[-2]}) == 2, "the ratio decides some documents"


def test_quality_edges(spark):
    labels = spark.createDataFrame([(15, 1, 0), (15, 0, 0), (27, 1, 0), (27, 1, None), (None, 1, 0), (30, None, None)], "doc_id long, quality int, toxic int")
    names = ["kept", "_words", "bucket", "llr"]
    p = quality.QualityRules()
    out = quality.quality_rules(edge_docs(spark, names), labels, p)
    assert rows_of(out, *COLUMNS) == quality_model(edge_rows(), [(15, 1, 0), (15, 0, 0), (27, 1, 0), (27, 1, None)], p)
    assert out.columns[:7] == ["doc_id", "text", "lang", "source", "n_chars", "_words", "bucket"]
    assert out.where("kept").count() == out.toPandas().kept.sum()
    assert quality.quality_rules(spark.createDataFrame([], SCHEMA), labels).count() == 0
    assert quality.quality_rules(edge_docs(spark), labels.limit(0)).where("llr <> 0").count() == 0


@pytest.mark.parametrize("folder, least", [(SMALL, 0.4), (MEDIUM, 0.7)])
def test_quality_finds_toxic_documents(spark, folder, least):
    """Production parameters at two sizes: most toxic documents go, nearly all trusted ones stay."""
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    judged = quality.quality_rules(docs, labels).where("n_words >= 50").join(labels, "doc_id").select("quality", "toxic", "kept").collect()
    toxic = [r.kept for r in judged if r.toxic]
    trusted = [r.kept for r in judged if r.quality == 1 and not r.toxic]
    assert toxic.count(False) >= least * len(toxic) > 0
    assert trusted.count(False) <= 0.02 * len(trusted)


def test_quality_counts_every_trusted_document(spark):
    n = 20_500
    docs = spark.range(n).select(F.col("id").alias("doc_id"), F.lit("word").alias("text"))
    labels = spark.range(n).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"), F.lit(0).alias("toxic"))
    (counts,) = quality.bucket_counts(docs, labels, quality.QualityRules()).collect()
    assert (counts.raw, counts.trusted) == (n, n)


def test_quality_orders(spark):
    docs, labels = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "labels"))
    out = quality.quality_rules(docs, labels, quality.QualityRules(orders=(1, 2), smoothing=3.0))
    assert out.where("llr < 0").count() > 0


def test_quality_query_weighs_pairs_with_both_signs(spark, tmp_path):
    """Same words, other neighbours: only pairs tell the texts apart, and what trusted texts hold speaks for them."""
    n, words = 1600, [f"w{i}" for i in range(60)]
    other = words[::2] + words[1::2]
    rows = [(i, " ".join(words if i % 2 else other)) for i in range(n)] + [(n, " ".join(words[:55])), (n + 1, "one two"), (n + 2, None)]
    labels = [(i, i % 2, 0) for i in range(n)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = {r.doc_id: r for r in op10_quality_rules(spark, str(tmp_path)).collect()}
    assert len(got) == n + 3 and got[1].llr > 0.2 > -0.2 > got[0].llr
    assert all(got[i].kept == (i % 2 == 1) for i in range(n)) and got[n].kept and not got[n + 1].kept and not got[n + 2].kept
    p = quality.RATIO
    hashed = spark.createDataFrame([(w,) for w in words], "w string").select("w", F.xxhash64("w").alias("h"))
    h = {r.w: r.h for r in hashed.collect()}
    pairs = {(a, b) for t in (words, other) for a, b in zip(t, t[1:])}
    both = spark.createDataFrame([(a, b, h[a], h[b]) for a, b in pairs], "a string, b string, x long, y long")
    at = {(r.a, r.b): r.at for r in both.select("a", "b", F.pmod(F.xxhash64("x", "y"), F.lit(p.buckets)).alias("at")).collect()}
    raw, good = collections.Counter(), collections.Counter()
    for d, t in rows:
        w = (t or "").split()
        for a, b in zip(w, w[1:]):
            raw[at.get((a, b), (a, b))] += 1
            good[at.get((a, b), (a, b))] += d % 2 if d < n else 0
    share = sum(good.values()) / sum(raw.values())
    weight = {b: math.log((good[b] + p.pair_smoothing) / (c * share + p.pair_smoothing)) for b, c in raw.items()}
    for d, t in ((0, other), (1, words)):
        total = sum(x for x in (weight[at[pair]] for pair in zip(t, t[1:])) if abs(x) > p.dead_zone)
        assert abs(got[d].llr - total / (2 * len(t) - 1)) < 1e-5


@pytest.mark.parametrize("folder, least", [(SMALL, 0.4), (MEDIUM, 0.7)])
def test_quality_query_finds_toxic_documents(spark, folder, least):
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    judged = op10_quality_rules(spark, folder).where("n_words >= 50").join(labels, "doc_id").select("quality", "toxic", "kept").collect()
    toxic = [r.kept for r in judged if r.toxic]
    trusted = [r.kept for r in judged if r.quality == 1 and not r.toxic]
    assert toxic.count(False) >= least * len(toxic) > 0
    assert trusted.count(False) <= 0.02 * len(trusted)


def test_substring_distance():
    rng = random.Random(5)
    for _ in range(300):
        item = "".join(rng.choice("abc") for _ in range(rng.randint(1, 12)))
        text = "".join(rng.choice("abc") for _ in range(rng.randint(0, 25)))
        want = min(edits(item, text[i:j]) for i in range(len(text) + 1) for j in range(i, len(text) + 1))
        assert decontaminate.substring_distance(item, text, 3) == (want if want <= 3 else None)


def leaks_model(docs, items, p):
    out = []
    for d, t in docs:
        text = decontaminate.fold(t)
        for i, item in items:
            item = decontaminate.fold(item)
            if len(item) >= p.min_chars:
                e = decontaminate.substring_distance(item, text, int(p.max_error * len(item)))
                if e is not None:
                    out.append((d, i, e))
    return sorted(out)


def test_leaks_equal_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    rng = np.random.default_rng(3)
    for k, (i, t) in enumerate(items):
        folded = decontaminate.fold(t)
        d, text = docs[k * 4 + 1]
        docs[k * 4 + 1] = (d, text[: len(text) // 2] + "\n" + [t.upper(), decontaminate.edited(folded, 0.03, rng), t.replace(" ", "  \n")][k % 3] + " " + text[len(text) // 2 :])
    p = decontaminate.LeakParams()
    want = leaks_model(docs, items, p)
    got = rows_of(decontaminate.find_leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), p), "doc_id", "item_id", "distance")
    got = sorted(got)
    assert set((d, i) for d, i, _ in got) <= set((d, i) for d, i, _ in want)
    assert len(got) >= 0.97 * len(want) >= 30


@pytest.mark.parametrize("p", [decontaminate.LeakParams(), decontaminate.LeakParams(entries=1, max_repetitions=2)])
def test_no_leak_is_left_out(spark, p):
    """Copies at the accepted error, of items that keys find and that they miss: each with its smallest distance."""
    rng, letters = np.random.default_rng(29), list("abcdeñгx")
    items = [(i, " ".join("".join(rng.choice(letters, rng.integers(1, 9))) for _ in range(4 + i % 40))) for i in range(120)]
    items = [(i, t) for i, t in items if len(t) >= p.min_chars]
    copies = [decontaminate.accepted_copies(items, p, rng) for _ in range(3)]
    docs = [(d, f"begin {text} {'end ' * (d % 3)}") for d, (_, text) in enumerate(x for y in copies for x in y)]
    docs += [(d, text.strip()) for d, text in enumerate((items[3][1], items[-1][1] * 2, items[5][1][9:], ""), 1000)]
    got = decontaminate.find_leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), p)
    want = leaks_model(docs, items, p)
    assert len(want) >= 200
    assert sorted(tuple(r) for r in got.collect()) == want


def test_recall_holds_up_to_the_accepted_error(spark, caplog):
    p = decontaminate.LeakParams()
    items = sorted((r.item_id, decontaminate.fold(r.text)) for r in spark.read.parquet(f"{MEDIUM}/benchmark.parquet").collect())
    items = [x for x in items if len(x[1]) >= p.min_chars]
    n = decontaminate.repetitions_for(items, p)
    assert not caplog.records
    rng = np.random.default_rng(123)  # not the copies the repetitions were fitted on
    found = [decontaminate.recall_of(items, decontaminate.accepted_copies(items, p, rng), p, n) for _ in range(5)]
    assert sum(found) / len(found) >= 0.95
    assert decontaminate.repetitions_for(items, decontaminate.LeakParams(entries=1, max_repetitions=2)) == 2
    assert len(caplog.records) == 1


def test_leaks_in_scripts_without_blanks(spark):
    rng = random.Random(11)
    docs, items = [], []
    for number, (a, b) in enumerate([(0xE01, 0xE2E), (0xE94, 0xEA3), (0x1000, 0x1020), (0x1780, 0x17A2), (0x4E00, 0x5000), (0xAC00, 0xAD00)]):
        letters = [chr(c) for c in range(a, b + 1) if chr(c).isalnum()]
        item = "".join(rng.choice(letters) for _ in range(80))
        around = ["".join(rng.choice(letters) for _ in range(50)) for _ in range(2)]
        copy = "".join(letters[(letters.index(c) + 1) % len(letters)] for c in item[:4]) + item[4:]
        items.append((number, item))
        docs.append((number, around[0] + copy + around[1]))
    found = decontaminate.find_leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert [r[:2] for r in rows_of(found, "doc_id", "item_id", "distance")] == [(i, i) for i in range(6)]
    starts = decontaminate.word_starts(np.frombuffer("กข ქართ ខគab".encode(), np.uint8)).tolist()
    assert starts == [0, 3, 7, 20, 23]


def test_leak_edges(spark):
    items = spark.createDataFrame([(1, None), (2, ""), (3, "short"), (4, "one two three four five six seven eight nine ten eleven twelve thirteen"), (None, "ünïcödé " * 9)], "item_id long, text string")
    out = decontaminate.find_leaks(edge_docs(spark, ["item_id", "distance"]), items).collect()
    assert {r.doc_id for r in out if r.item_id == 4} == {15, 18, 21, 24, None}
    assert sum(r.doc_id == 15 for r in out) == 3
    assert decontaminate.find_leaks(spark.createDataFrame([], SCHEMA), items).count() == 0
    assert decontaminate.find_leaks(edge_docs(spark), items.limit(0)).count() == 0


def test_blocks_find_the_same(spark):
    docs, items = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "benchmark"))
    whole = rows_of(decontaminate.find_leaks(docs, items), "doc_id", "item_id")
    parts = rows_of(decontaminate.find_leaks(docs, items, decontaminate.LeakParams(block_items=15)), "doc_id", "item_id")
    assert whole == parts


def template_lines(n, seed=8):
    """Lines of one template: 50 fixed, 30 random and 47 fixed characters; each seventh has a near copy."""
    rng = random.Random(seed)
    letters = "abcdefghijklmnopqrstuvwxyz"
    word = lambda k: "".join(rng.choice(letters) for _ in range(k))
    head, tail, out = word(50), word(47), []
    for i in range(n):
        middle = word(30)
        out.append(head + middle + tail)
        if i % 7 == 0:
            at = rng.randrange(127)
            out.append(out[-1][:at] + "#" + out[-1][at + 1 :])
    return out


def test_lines_of_one_template_stay_linear(spark, monkeypatch):
    """Large buckets of a common phrase are cut again until pairs are few; every near copy is found."""
    seen = []
    keep = line_dedup.written

    def counted(df, name):
        out = keep(df, name)
        seen.append((name, out.count()))
        return out

    monkeypatch.setattr(line_dedup, "written", counted)
    lines = template_lines(6000)
    docs = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "doc_id long, text string")
    got = {r.doc_id for r in line_dedup.dedup_lines(docs).where("n_near > 0").collect()}
    assert got == {i for i, x in enumerate(lines) if "#" in x}
    assert len([x for x in seen if x[0] == "line-pieces"]) >= 2, "cut again more than once"
    assert max(c for _, c in seen) < 12 * len(lines)


def test_a_line_is_looked_up_once_not_once_a_bucket(spark, monkeypatch):
    """Lines of one template share many buckets; their places and flags come by line, so no step joins a bucket's rows by id."""
    joined, keep = [], line_dedup.written

    def looked(df, name):
        if name in ("line-done", "line-buckets"):
            plan = df._jdf.queryExecution().optimizedPlan().toString()
            joined.append((name, len(re.findall(r"Join \w+, \(id#\d+L = id#\d+L\)", plan))))
        return keep(df, name)

    monkeypatch.setattr(line_dedup, "written", looked)
    lines = template_lines(300)
    docs = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "doc_id long, text string")
    got = {r.doc_id for r in line_dedup.dedup_lines(docs).where("n_near > 0").collect()}
    assert got == {i for i, x in enumerate(lines) if "#" in x}
    assert {name for name, _ in joined} == {"line-done", "line-buckets"}
    assert sum(n for _, n in joined) == 0


def test_rows_of_a_bucket_of_two_are_not_joined(spark, monkeypatch):
    """A bucket's size comes with its rows: buckets of two are paired by the aggregate, and what is settled is left out without a second full join."""
    least, inner, keep, spread = [], [], line_dedup.written, line_dedup.with_bucket

    def joined(rows, **aggregates):
        least.append(rows.groupBy("key").agg(F.countDistinct("id").alias("n")).agg(F.min("n")).first()[0])
        return spread(rows, **aggregates)

    def looked(df, name):
        if name == "line-buckets":
            plan = df._jdf.queryExecution().optimizedPlan().toString()
            inner.append(len(re.findall(r"Join Inner, \(key#\d+L = key#\d+L\)", plan)))
        return keep(df, name)

    monkeypatch.setattr(line_dedup, "with_bucket", joined)
    monkeypatch.setattr(line_dedup, "written", looked)
    rng = random.Random(6)
    alone = ["".join(rng.choice("abcdefghijklmnop ") for _ in range(80)) for _ in range(40)]
    rows = list(enumerate([*template_lines(200), *alone, *[x[:40] + "#" + x[40:] for x in alone]]))
    got = dict(rows_of(line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")), "doc_id", "text"))
    assert got == lines_model(rows, line_dedup.LineParams())
    assert least and min(least) > 2
    assert inner and sum(inner) == 0


def test_a_bucket_knows_its_size(spark):
    """Lines are counted once, however many pieces and substrings bring them to a bucket."""
    rows = [(7, 1, 10, 0, True), (7, 1, 10, 3, True), (7, 1, 11, 4, False), (7, 2, 12, 5, True), (8, 1, 10, 0, True), (8, 3, 13, 1, False), (9, 1, 10, 0, True)]
    found = line_dedup.shared_buckets(spark.createDataFrame(rows, "key long, id long, piece long, slot int, live boolean").withColumn("scope", F.lit(5).cast("long")), 2)
    assert sorted(rows_of(found, "key", "id", "piece", "size")) == [(7, 1, 10, 2), (7, 1, 11, 2), (7, 2, 12, 2), (8, 1, 10, 2), (8, 3, 13, 2)]


def test_plans_hold_no_tables(spark):
    """Weights and screens of fixed size are read by Spark; no plan prints them."""
    docs, labels = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "labels"))
    for df in (quality.quality_rules(docs, labels), quality.bucket_counts(docs, labels, quality.QualityRules()), line_dedup.dedup_lines(docs)):
        assert len(df._jdf.queryExecution().toString()) < 50_000


def test_a_null_id_text_is_linked(spark):
    """A class without any id is measured like the others, and gives way to the copy that has one."""
    base = [f"w{i}" for i in range(60)]
    near = [*base[:59], "other"]
    rows = [(None, " ".join(near)), (5, " ".join(base)), (None, " ".join(near)), (9, "something else altogether here")]
    out = jaccard_join.jaccard_join(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((repr(r.doc_id), r.component_id) for r in out) == [("5", 5), ("9", 9), ("None", 5), ("None", 5)]
