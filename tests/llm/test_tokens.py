"""Token counts, packing and token files against the library and plain models."""

import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cataloguer.llm import bpe, packing, simple8b, token_counts, token_files

from ..conftest import SMALL
from .helpers import EDGE_TEXTS, SCHEMA, edge_docs, edge_rows


@lru_cache(1)
def encoder():
    return bpe.WordEncoder(bpe.default_vocabulary())


def library_ids(text):
    return encoder()._tok.encode(text or "", add_special_tokens=False).ids


def word_ids(texts):
    out = []
    for lo, hi, ids, counts in encoder().encode(pa.array(texts, pa.string())):
        stop = np.cumsum(counts)
        out += [ids[e - n : e].tolist() for e, n in zip(stop, counts)]
    return out


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(max_size=40), st.text(alphabet="ab '\n\t 1_é×,.!", max_size=60)), max_size=6))
def test_ids_equal_the_library(texts):
    assert word_ids(texts) == [library_ids(t) for t in texts]


def test_ids_survive_an_emptied_index(monkeypatch):
    monkeypatch.setattr(bpe, "MEMO_WORDS", 5)
    texts = ["one two three four five six seven", "eight nine ten one two", "one"] * 2
    assert word_ids(texts) == [library_ids(t) for t in texts]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 60_000), st.integers(0, 2**64 - 1)), max_size=200))
def test_simple8b_round_trip(values):
    v = np.array(values, np.uint64)
    assert simple8b.decode(simple8b.encode(v), len(v)).tolist() == values


def test_simple8b_is_dense():
    assert len(simple8b.encode(np.zeros(600, np.uint64))) == 10
    assert len(simple8b.encode(np.full(600, 30_000, np.uint64))) == 150


def test_token_files_hold_all_ids_in_doc_id_order(spark):
    rows = edge_rows()
    got = sorted((tuple(r) for r in token_files.document_digests(token_files.write_shards(edge_docs(spark, ["shard", "block", "n"])))
                  .select("start", "n_tokens", "ids_crc32", "doc_id").collect()))
    assert [r[3] for r in got] == sorted((r[0] for r in rows), key=lambda d: (d is not None, d or 0))
    want = sorted((-1 if d is None else d, len(library_ids(t)) + 1, crc(library_ids(t) + [0])) for d, t, *_ in rows)
    assert sorted((-1 if d is None else d, n, c) for _, n, c, d in got) == want
    assert [r[0] for r in got] == np.concatenate([[0], np.cumsum([r[1] for r in got])[:-1]]).tolist()


def test_token_files_documents_over_many_blocks(spark, monkeypatch):
    ids = np.arange(1000, dtype=np.uint32)
    monkeypatch.setattr(token_files, "BLOCK", 300)
    blocks = token_files._Blocks(0)
    rows = [r for r in blocks.add(7, ids)] + [blocks.row()]
    back = np.concatenate([token_files.read_ids(r[5], r[6], sum(r[3])) for r in rows])
    assert back.tolist() == ids.tolist() and [r[4] for r in rows] == [[False]] * 3 + [[True]]
    assert token_files.read_ids(rows[1][5], rows[1][6], 300, 20, 25).tolist() == [320, 321, 322, 323, 324]


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert token_files.document_digests(token_files.write_shards(none)).count() == 0
    assert packing.pack(none).count() == 0
    assert token_counts.token_counts(none).count() == 0


def check_pieces(pieces, window):
    by_doc, by_sequence = {}, {}
    for p in pieces:
        by_doc.setdefault((p.doc_id, p.doc_tokens, p.source), []).append(p)
        by_sequence.setdefault(p.sequence_id, []).append(p)
    for parts in by_sequence.values():
        at = 0
        for p in sorted(parts, key=lambda p: p.offset):
            assert p.offset == at and p.length > 0
            at += p.length
        assert at <= window
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    total = sum(p.length for p in pieces)
    assert len(by_sequence) == -(-total // window)
    return by_doc, by_sequence


@pytest.mark.parametrize("weights", [None, {None: 1, "s0": 5, "s1": 1, "s2": 0.5}])
def test_packing_holds_every_id_once(spark, weights):
    pieces = packing.pack(edge_docs(spark, ["part", "before", "first"]), window=256, weights=weights).collect()
    check_pieces(pieces, 256)
    want = sorted((repr(d), i, v) for d, t, *_ in edge_rows() for i, v in [(len(library_ids(t)) + 1, 0)])
    got = {}
    for p in pieces:
        got.setdefault((repr(p.doc_id), p.doc_tokens), 0)
        got[repr(p.doc_id), p.doc_tokens] += p.length
    assert sum(got.values()) == sum(w[1] for w in want)
    single = {d: t for d, t, *_ in edge_rows() if [r[0] for r in edge_rows()].count(d) == 1}
    for d, t in single.items():
        ids = library_ids(t) + [1]
        own = sorted((p for p in pieces if p.doc_id == d), key=lambda p: p.start)
        assert [p.start for p in own] == np.concatenate([[0], np.cumsum([p.length for p in own])[:-1]]).tolist()
        assert [p.ids_crc32 for p in own] == [crc(ids[p.start : p.start + p.length]) for p in own]


@pytest.mark.parametrize("weighted", [False, True])
@pytest.mark.parametrize("most", [1, 4])
def test_packing_takes_more_sources_than_queues(spark, weighted, most):
    rows = [(i, f"text number {i} of its source " * (1 + i % 5), f"site{i % 40}.org" if i % 41 else None) for i in range(200)]
    weights = {s: 1 + len(s or "") % 3 for s in {r[2] for r in rows}} if weighted else None
    pieces = packing.pack(spark.createDataFrame(rows, "doc_id long, text string, source string"), window=64, weights=weights, max_sources=most).collect()
    by_doc, _ = check_pieces(pieces, 64)
    assert len(by_doc) == len(rows)
    for i, t, source in rows:
        ids = library_ids(t) + [1]
        own = sorted(by_doc[i, len(ids), source], key=lambda p: p.start)
        assert [p.start for p in own] == np.concatenate([[0], np.cumsum([p.length for p in own])[:-1]]).tolist()
        assert sum(p.length for p in own) == len(ids)
        assert [p.ids_crc32 for p in own] == [crc(ids[p.start : p.start + p.length]) for p in own]


def test_packing_keeps_the_mixture(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    pieces = packing.pack(docs).toPandas()
    mix = pieces.groupby(["sequence_id", "source"]).length.sum().unstack(fill_value=0)
    target = mix.sum() / mix.sum().sum() * 2048
    assert (mix.iloc[:-1] - target).abs().max().max() < 2 * len(target)
    assert (mix.iloc[:-1].sum(axis=1) == 2048).all()


def test_rounds_are_a_partition_of_the_stream():
    rounds = packing.Rounds([700, 1, 5000, 33], [7, 1, 3, 3], 64)
    seen = sorted((at, n, s) for s, t in enumerate(rounds.totals) for _, n, at in rounds.cut(s, 0, t))
    at = 0
    for place, n, _ in seen:
        assert place == at
        at += n
    assert at == 5734


def best_count(word, scores):
    best = [(0, 0)]
    for e in range(1, len(word) + 1):
        best.append(max((best[s][0] + scores[word[s:e]], best[s][1] - 1) for s in range(e) if word[s:e] in scores))
    return -best[-1][1]


def test_token_counts_equal_plain_viterbi(spark):
    import public_tokenizers
    import regex

    scores = token_counts.piece_scores(token_counts.default_vocabulary())
    pattern = regex.compile(public_tokenizers.PATTERN)
    want = []
    for d, t, *_ in edge_rows():
        words = pattern.findall(t[:4000] if t else "")
        want.append((repr(d), len(words), sum(best_count(w.encode(), scores) for w in words if len(w) < 500)))
    from pyspark.sql import functions as F

    got = token_counts.token_counts(edge_docs(spark, ["n_tokens"]).withColumn("text", F.substring("text", 1, 4000))).collect()
    short = [w for w in want if w[0] != repr(3 * EDGE_TEXTS.index("aaaa" * 400))]
    assert sorted(tuple([repr(r.doc_id), r.n_pretokens, r.n_tokens]) for r in got if r.doc_id != 3 * EDGE_TEXTS.index("aaaa" * 400)) == sorted(short)


def test_a_shared_prefix_is_scored_once():
    trie = token_counts.UnigramTrie({b"a": -5, b"b": -5, b"ab": -7, b"abb": -20, b"c": -1})
    assert trie.counts(sorted([b"a", b"ab", b"abb", b"abc", b"cab"])) == [1, 1, 2, 2, 2]


def thue_morse(n=1024):
    """A word over a and b and its complement: the hash over prefix sums alone cannot tell them apart."""
    bits = [bin(i).count("1") % 2 for i in range(n)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


def test_regular_long_words_are_told_apart(spark):
    from cataloguer.llm import bytesops, jaccard_join

    one, two = thue_morse()
    data = np.frombuffer((one + two).encode(), np.uint8)
    prefix, at = bytesops.prefix_hash(data), np.array([0, 1024])
    assert len(set(bytesops.span_hash(prefix, at, at + 1024).tolist())) == 1, "they collide"
    texts = [one, two, f"{one} x {two}", f"{two} x {one}"]
    assert word_ids(texts) == [library_ids(t) for t in texts]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").coalesce(1)
    out = {r.doc_id: r.component_id for r in jaccard_join.jaccard_join(df).collect()}
    assert out == {0: 0, 1: 1, 2: 2, 3: 3}
    counted = [r.n_tokens for r in token_counts.token_counts(df).orderBy("doc_id").collect()]
    trie = token_counts.UnigramTrie(token_counts.piece_scores(token_counts.default_vocabulary()))
    assert counted[:2] == [trie.counts([w.encode()])[0] for w in (one, two)]


def test_equal_hashes_are_compared_by_bytes(monkeypatch):
    """With eight hash values nearly all words collide; ids and counts stay right."""
    real = bpe.span_hash
    texts = ["one two three four five six seven eight", "nine ten one two", None, "it's", "one", "日本 two one", "a b c d e f g h i j k l m n"] * 2
    counter = token_counts.PretokenCounter(token_counts.default_vocabulary())
    from cataloguer.llm.bytesops import text_chunks

    chunk = next(text_chunks(pa.array(texts, pa.string())))[2:]
    want = [x.tolist() for x in counter.chunk(*chunk)]
    for module in (bpe, token_counts):
        monkeypatch.setattr(module, "span_hash", lambda *a: real(*a) % np.uint64(8))
    encoder.cache_clear()
    assert word_ids(texts) == [library_ids(t) for t in texts]
    counter._forget()
    assert [x.tolist() for x in counter.chunk(*chunk)] == want
    encoder.cache_clear()


def test_long_pretokens_are_counted_whole(spark):
    """Words of 500 bytes and more, and whole texts, against the plain recursion."""
    import public_tokenizers
    import regex

    scores = token_counts.piece_scores(token_counts.default_vocabulary())
    longest = max(map(len, scores))
    text = "y" * 1500 + " " + "abcdefgh" * 90 + " end"

    def tokens(word):
        best = [(0, 0)]
        for e in range(1, len(word) + 1):
            best.append(max((best[s][0] + scores[word[s:e]], best[s][1] - 1) for s in range(max(0, e - longest), e) if word[s:e] in scores))
        return -best[-1][1]

    words = [w.encode() for w in regex.findall(public_tokenizers.PATTERN, text)]
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    r = token_counts.token_counts(df).first()
    assert (r.n_pretokens, r.n_tokens) == (len(words), sum(map(tokens, words)))
