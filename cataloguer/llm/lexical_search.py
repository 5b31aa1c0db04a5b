r"""Ranked lexical search of documents for benchmark items, by an Aho-Corasick scan of the texts.

Terms are the maximal matches of ``[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+``, only A-Z
lower-cased: digits, ASCII letters and all characters beyond ASCII. No index of the
documents is built. The automaton holds every term of all items between two blanks, its
boundary guards; a text is scanned once, with each byte outside terms made a blank,
so a hit is a whole term. Outputs of the automaton are term numbers, which map to items.

* Scan: per document its number of terms and the counts of the items' terms found in
  it, written as narrow rows (no text). Document frequencies, the number of documents
  and of terms are sums over these rows.
* Score: per batch a product of two matrices, (documents x terms found) times (terms x
  items). All parts are whole numbers and their sums stay below 2^53, so float64 holds
  them exactly; a batch that could leave that range is summed in 64-bit integers. Each
  task keeps its ``top`` best per item, and a ranked window per item takes the best of all.

Items are taken in blocks of at most about ``block_bytes`` of text; each block is one
broadcast automaton and one scan, so nothing broadcast grows with the benchmark.

Defined cases: a null or empty text has no term and counts nowhere; every row is a
document, also with a doc_id in use; a null doc_id comes after any other among equal
scores; item rows of equal item_id are one item with the terms of all; items with a
null id or no term find nothing; extra columns are not looked at; empty tables give none.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bytesops import flat_ranges, text_chunks
from .registry import written

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Each byte as the scan sees it: terms in lower case, all else blank.
_SEEN = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_IS_TERM = np.frombuffer(_SEEN, np.uint8) != 32
_HITS = "doc_id long, n long, terms binary, counts binary"
_EXACT = 1 << 53


@dataclass(frozen=True)
class SearchParams:
    """Production parameters."""

    top: int = 50
    block_bytes: int = 8 << 20
    batch_docs: int = 256
    batch_items: int = 512
    batch_terms: int = 8192


def item_terms(items: DataFrame) -> DataFrame:
    """(item_id, term): distinct terms of every item."""
    folded = F.translate("text", _UPPER, _LOWER)
    return items.where(F.col("item_id").isNotNull() & F.col("text").isNotNull()).select(
        F.col("item_id").cast("long").alias("item_id"), F.explode(F.regexp_extract_all(folded, F.lit(TERM), 0)).alias("term")
    ).distinct()


def scan(docs: DataFrame, terms: list[str]) -> DataFrame:
    """(doc_id, n, terms, counts) of every document: its terms in all, and numbers (int32) and counts (int64) of ``terms`` found."""
    shared = docs.sparkSession.sparkContext.broadcast(terms)  # at most a block's text

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import ahocorasick

        automaton = ahocorasick.Automaton()
        for number, term in enumerate(shared.value):
            automaton.add_word(f" {term} ", number)
        if shared.value:
            automaton.make_automaton()
        for b in batches:
            for lo, hi, data, offsets in text_chunks(b.column(1)):
                inside = _IS_TERM[data]
                start = inside.copy()
                start[1:] &= ~inside[:-1]
                firsts = offsets[:-1][offsets[:-1] < offsets[1:]]
                start[firsts] = inside[firsts]
                sums = np.concatenate([[0], np.cumsum(start)])
                raw, numbers, counts = data.tobytes().translate(_SEEN), [], []
                for a, e in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
                    text = f" {raw[a:e].decode()} "
                    found = np.fromiter((v for _, v in automaton.iter(text)), np.int32) if shared.value else np.zeros(0, np.int32)
                    which, times = np.unique(found, return_counts=True)
                    numbers.append(which.astype("<i4").tobytes())
                    counts.append(times.astype("<i8").tobytes())
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, hi - lo), pa.array(sums[offsets[1:]] - sums[offsets[:-1]], pa.int64()),
                     pa.array(numbers, pa.binary()), pa.array(counts, pa.binary())], ["doc_id", "n", "terms", "counts"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(search, _HITS)


def document_frequencies(hits: DataFrame, n_terms: int) -> dict[int, int]:
    """How many documents hold each term of the block (one row per term found reaches the driver)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_terms, np.int64)
        for b in batches:
            found = np.frombuffer(b"".join(b.column(0).to_pylist()), "<i4")
            total += np.bincount(found, minlength=n_terms)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], ["term", "df"])

    if not n_terms:
        return {}
    rows = hits.select("terms").mapInArrow(count, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).collect()
    return {r["term"]: r["df"] for r in rows}


def best_of(keys: np.ndarray, scores: np.ndarray, ids: np.ndarray, top: int) -> np.ndarray:
    """Places of the ``top`` best entries of each key: higher scores first, then smaller ids."""
    order = np.lexsort((ids, -scores, keys))
    sorted_keys = keys[order]
    new = np.concatenate([[True], sorted_keys[1:] != sorted_keys[:-1]])
    first = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
    return order[np.arange(len(order)) - first < top]


def score(hits: DataFrame, postings: dict[int, list[int]], weights: dict[int, int], item_ids: list[int], n_docs: int, n_all: int, p: SearchParams) -> DataFrame:
    """(item_id, doc_id, score): each task's ``top`` best documents of every item."""
    shared = hits.sparkSession.sparkContext.broadcast((postings, weights, item_ids))  # a block's items
    none_last = np.iinfo(np.int64).max

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        posts, weight, names = shared.value
        names = np.array(names, np.int64)
        w_of = np.zeros(max(posts, default=0) + 1, np.int64)
        w_of[list(weight)] = list(weight.values())
        sizes = np.array([len(posts.get(t, ())) for t in range(len(w_of))], np.int64)
        firsts = np.cumsum(sizes) - sizes
        holders = np.array([i for t in range(len(w_of)) for i in posts.get(t, ())], np.int64)
        best = [np.zeros(0, np.int64) for _ in range(4)]  # item, score, doc_id, doc_id is null
        floor = np.zeros(len(names), np.int64)  # an item's score to reach: its last of ``top`` so far

        def take(found: list[np.ndarray]) -> list[np.ndarray]:
            both = [np.concatenate([x, y]) for x, y in zip(best, found)]
            keep = best_of(both[0], both[1], both[2], p.top)
            both = [x[keep] for x in both]
            full = np.bincount(both[0], minlength=len(names)) == p.top
            least = np.full(len(names), none_last)
            np.minimum.at(least, both[0], both[1])
            floor[full] = least[full]
            return both

        for b in batches:
            for lo in range(0, b.num_rows, p.batch_docs):
                part = b.slice(lo, p.batch_docs)
                terms = [np.frombuffer(x, "<i4") for x in part.column(2).to_pylist()]
                flat = np.concatenate(terms).astype(np.int64)
                if not len(flat):
                    continue
                tf = np.frombuffer(b"".join(part.column(3).to_pylist()), "<i8")
                row = np.repeat(np.arange(part.num_rows), [len(t) for t in terms])
                n = part.column(1).to_numpy()
                m = 100 - 50 + (50 * n * n_docs) // n_all
                value = w_of[flat] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m[row]))
                used, column = np.unique(flat, return_inverse=True)
                ids = part.column(0)
                doc = ids.fill_null(none_last).to_numpy()
                none = ids.is_null().to_numpy(zero_copy_only=False).astype(np.int64)
                exact = np.bincount(row, value, part.num_rows).max() < _EXACT // 2
                kind = np.float64 if exact else np.int64
                for low in range(0, len(names), p.batch_items):
                    width = min(p.batch_items, len(names) - low)
                    total = np.zeros((part.num_rows, width), kind)
                    for at in range(0, len(used), p.batch_terms):
                        some = used[at : at + p.batch_terms]
                        here = (column >= at) & (column < at + len(some))
                        left = np.zeros((part.num_rows, len(some)), kind)
                        left[row[here], column[here] - at] = value[here]
                        items = holders[flat_ranges(firsts[some], sizes[some])] - low
                        term = np.repeat(np.arange(len(some)), sizes[some])
                        inside = (items >= 0) & (items < width)
                        right = np.zeros((len(some), width), kind)
                        right[term[inside], items[inside]] = 1
                        total += left @ right
                    r, i = np.nonzero((total > 0) & (total >= floor[low : low + width]))
                    if len(r):
                        best = take([i + low, total[r, i].astype(np.int64), doc[r], none[r]])
        yield pa.RecordBatch.from_arrays(
            [pa.array(names[best[0]], pa.int64()), pa.array(best[2], pa.int64(), mask=best[3].astype(bool)), pa.array(best[1], pa.int64())],
            ["item_id", "doc_id", "score"])

    return hits.mapInArrow(rank, "item_id long, doc_id long, score long")


def weight_of(n_docs: int, df: int) -> int:
    """Weight of a term that ``df`` of ``n_docs`` documents hold."""
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def _block_scores(docs: DataFrame, rows: list, p: SearchParams) -> DataFrame | None:
    terms = sorted({r["term"] for r in rows})
    item_ids = sorted({r["item_id"] for r in rows})
    number, place = {t: k for k, t in enumerate(terms)}, {i: k for k, i in enumerate(item_ids)}
    hits = written(scan(docs, terms), "search-hits")
    total = hits.where("n > 0").agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("terms")).first()
    if not total["docs"]:
        return None
    frequency = document_frequencies(hits, len(terms))
    postings: dict[int, list[int]] = {}
    for r in rows:
        if number[r["term"]] in frequency:
            postings.setdefault(number[r["term"]], []).append(place[r["item_id"]])
    weights = {t: weight_of(total["docs"], df) for t, df in frequency.items()}
    return score(hits, postings, weights, item_ids, total["docs"], total["terms"], p)


def ranked_search(docs: DataFrame, items: DataFrame, params: SearchParams = SearchParams()) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` best documents of ``docs`` (doc_id, text) for each of ``items`` (item_id, text)."""
    size = items.agg(F.sum(F.octet_length("text")).alias("size")).first()["size"] or 0
    blocks = math.ceil(size * 1.2 / params.block_bytes)
    terms = item_terms(items)
    if blocks > 1:
        terms = written(terms, "search-terms")
    found = docs.sparkSession.createDataFrame([], "item_id long, doc_id long, score long")
    for k in range(blocks):
        block = terms.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == k) if blocks > 1 else terms
        part = _block_scores(docs, block.collect(), params)
        found = found if part is None else part if k == 0 else found.union(part)
    best = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= params.top).select("item_id", "rank", "doc_id", "score")
