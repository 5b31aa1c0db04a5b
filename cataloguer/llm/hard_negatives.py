"""Hard negatives by rotated one-bit codes: interval filter, then integer scores.

A row's components become ``floor(256 x)``. Anchors are the rows whose vec_id is
divisible by ``anchor_every``; an anchor's positives are its ``positives`` best other rows
of the same label, and for each positive the ``negatives`` best rows of another label
with ``low_percent * p <= 100 * score <= high_percent * p`` are its hard negatives.

Codes. Vectors are turned by one random rotation; a row keeps the signs of the turned
vector (one bit a component), its alignment ``a`` (inner product with the unit vector
``s`` of its signs) and the length ``r`` of what is left, ``x - a s``, which is orthogonal
to ``s``. For an anchor ``q`` (turned, as integers of a few bits, in bit planes)
popcounts give ``t = <q, s>`` up to the rounding ``d``. Then ``<q, x> = a <q, s> + <q, x - a s>``
and, by Cauchy-Schwarz, the second part is at most ``r`` times the length of the
part of ``q`` orthogonal to ``s``. So ``a t`` lies within ``a d + r sqrt(|q|^2 - (|t| - d)^2)``
of the score, always, and a pair is left out only if that interval cannot reach a
place among the best. Pairs that stay are scored in integers, so results are exact.

Anchors grow with the table, so they go round in blocks of at most about
``block_bytes``: a block is one broadcast and one scan of the codes. What must be
reached is first worked out on the block's own anchors, real rows of the table, and
rises while a task runs; a task returns at most a few rows an anchor.

Defined cases: rows with a null vec_id, label or vector, or any null or non-finite
component take no part; a shorter vector counts as filled up with zeros; of rows with
an anchor's vec_id one (smallest label, then components) is the anchor and none is its
positive; candidates of equal vec_id and score are one; extra columns are not looked
at; scores are exact while they fit 64 bits and are cut to that range beyond; an empty table gives none.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .lexical_search import best_of
from .registry import written

_INDEX = "vec_id long, label long, code binary, align double, rest double, vector binary"
_FOUND = "anchor_id long, slot int, vec_id long, score long"
_LEAST = np.iinfo(np.int64).min


@dataclass(frozen=True)
class MiningParams:
    """Production parameters."""

    scale: int = 256
    anchor_every: int = 50
    positives: int = 5
    negatives: int = 3
    low_percent: int = 50
    high_percent: int = 95
    query_bits: int = 6
    seed: int = 20
    block_bytes: int = 16 << 20
    batch_rows: int = 2048
    batch_anchors: int = 256


@lru_cache(maxsize=2)
def rotation(dim: int, seed: int) -> np.ndarray:
    """A random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def whole_components(vectors: list, dim: int, scale: int) -> np.ndarray:
    """Components as whole float64 numbers, filled up with zeros to ``dim``."""
    out = np.zeros((len(vectors), dim))
    for k, v in enumerate(vectors):
        out[k, : len(v)] = v
    return np.floor(scale * out)


def packed(bits: np.ndarray) -> np.ndarray:
    """Rows of booleans as 64-bit words."""
    raw = np.packbits(bits, axis=1)
    return np.pad(raw, ((0, 0), (0, -raw.shape[1] % 8))).view(np.uint64)


def encode(vectors: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes (64-bit words), alignments and lengths of the rest of whole-number vectors."""
    dim = vectors.shape[1]
    turned = vectors @ rotation(dim, seed).T
    align = np.abs(turned).sum(axis=1) / math.sqrt(dim)
    rest = np.sqrt(np.maximum((vectors * vectors).sum(axis=1) - align * align, 0))
    return packed(turned > 0), align, rest


def usable(embeddings: DataFrame) -> DataFrame:
    """Rows that take part: (vec_id, label, embedding)."""
    finite = F.forall("embedding", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
                             F.col("embedding").cast("array<double>").alias("embedding")).where(
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & finite)


def build_index(rows: DataFrame, dim: int, p: MiningParams) -> DataFrame:
    """The code, alignment, rest and whole-number vector of every row of ``rows`` (vec_id, label, embedding), written."""

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, p.batch_rows):
                part = b.slice(lo, p.batch_rows)
                x = whole_components(part.column(2).to_pylist(), dim, p.scale)
                words, align, rest = encode(x, p.seed)
                yield pa.RecordBatch.from_arrays([
                    part.column(0), part.column(1), pa.array([w.tobytes() for w in words], pa.binary()), pa.array(align), pa.array(rest),
                    pa.array([v.tobytes() for v in x.astype("<f8")], pa.binary()),
                ], [c.split()[0] for c in _INDEX.split(", ")])

    return written(rows.mapInArrow(code, _INDEX), "mining-index")


class Queries:
    """Anchors in bit planes, with the signs' inner products they need."""

    def __init__(self, vectors: np.ndarray, p: MiningParams):
        dim = vectors.shape[1]
        turned = vectors @ rotation(dim, p.seed).T
        self.root, self.low = math.sqrt(dim), turned.min(axis=1)
        self.step = np.maximum((turned.max(axis=1) - self.low) / ((1 << p.query_bits) - 1), 1e-300)
        whole = np.rint((turned - self.low[:, None]) / self.step[:, None]).astype(np.int64)
        self.planes = [packed((whole >> j) & 1 == 1) for j in range(p.query_bits)]
        self.total = (self.low[:, None] + self.step[:, None] * whole).sum(axis=1)
        self.error = self.step / 2 * self.root
        self.square = (vectors * vectors).sum(axis=1)
        self.length = np.sqrt(self.square)

    def intervals(self, at: slice, codes: np.ndarray, align: np.ndarray, rest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bounds (rows x anchors) within which each score lies."""
        counts = np.zeros((len(codes), len(self.low[at])), np.uint32)
        for plane in reversed(self.planes):  # highest bit first
            counts <<= 1
            for w in range(codes.shape[1]):
                counts += np.bitwise_count(codes[:, w, None] & plane[at][None, :, w])
        ones = np.bitwise_count(codes).sum(axis=1, dtype=np.float64)
        t = (2 * (self.step[at] * counts + self.low[at] * ones[:, None]) - self.total[at]) / self.root
        sure = np.maximum(np.abs(t) - self.error[at], 0)
        across = np.sqrt(np.maximum(self.square[at] - sure * sure, 0))
        # float64 sums of whole numbers: far less than a billionth of the lengths' product is lost
        lost = 1e-9 * self.length[at] * (align + rest)[:, None] + 1e-6
        half = align[:, None] * self.error[at] + rest[:, None] * across + lost
        middle = align[:, None] * t
        return np.nan_to_num(middle - half, nan=-np.inf, neginf=-np.inf), np.nan_to_num(middle + half, nan=np.inf, posinf=np.inf)


def whole_scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products of the rows of two matrices of whole numbers."""
    if not len(a):
        return np.zeros(0, np.int64)
    if a.shape[1] * max(np.abs(a).max(), 1) * max(np.abs(b).max(), 1) < 2.0**62:
        return np.einsum("ij,ij->i", a.astype(np.int64), b.astype(np.int64))
    limit = (1 << 63) - 1
    return np.array([max(-limit, min(limit, sum(int(x) * int(y) for x, y in zip(r, s)))) for r, s in zip(a, b)], np.int64)


def tile_scores(x: np.ndarray, q: np.ndarray, r: np.ndarray, a: np.ndarray) -> np.ndarray:
    """Integer inner products of the rows ``r`` of x with the rows ``a`` of q, where many pairs of the two are wanted.

    A float64 product of whole numbers is exact below 2^53: one matrix product serves a tile.
    """
    exact = x.shape[1] * max(np.abs(x).max(initial=0), 1) * max(np.abs(q).max(initial=0), 1) < 2.0**53
    if exact and 32 * len(r) > len(x) * len(q):
        return (x @ q.T)[r, a].astype(np.int64)
    steps = [slice(k, k + (1 << 16)) for k in range(0, len(r), 1 << 16)]
    return np.concatenate([whole_scores(x[r[s]], q[a[s]]) for s in steps]) if steps else np.zeros(0, np.int64)


def matrix(column: list[bytes], kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(column), kind).reshape(len(column), -1)


def search(index: DataFrame, block: dict, k: int, same_label: bool, p: MiningParams) -> DataFrame:
    """(anchor_id, slot, vec_id, score): each task's ``k`` best rows of every slot of the block's anchors.

    ``block``: ids, labels and vectors of the anchors, and per anchor and slot the
    scores allowed (``low`` to ``high``) and the score to reach (``reach``). An unused slot has low > high.
    """
    shared = index.sparkSession.sparkContext.broadcast(block)  # at most about block_bytes

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given = shared.value
        ids, labels, vectors = given["ids"], given["labels"], matrix(given["vectors"], "<f8")
        low, high, n_slots = given["low"], given["high"], given["low"].shape[1]
        reach = np.maximum(given["reach"], low)
        used = low <= high
        queries = Queries(vectors, p)
        best = [np.zeros(0, np.int64) for _ in range(3)]  # anchor * n_slots + slot, score, vec_id

        def take(found: list[np.ndarray]) -> list[np.ndarray]:
            both = [np.concatenate([x, y]) for x, y in zip(best, found)]
            order = np.lexsort((both[2], -both[1], both[0]))
            both = [x[order] for x in both]
            new = np.concatenate([[True], np.logical_or.reduce([x[1:] != x[:-1] for x in both])])
            both = [x[new] for x in both]
            keep = best_of(both[0], both[1], both[2], k)
            both = [x[keep] for x in both]
            full = np.bincount(both[0], minlength=low.size) == k
            least = np.full(low.size, np.iinfo(np.int64).max)
            np.minimum.at(least, both[0], both[1])
            flat = reach.reshape(-1)
            flat[full] = np.maximum(flat[full], least[full])
            return both

        for b in batches:
            for lo in range(0, b.num_rows, p.batch_rows):
                part = b.slice(lo, p.batch_rows)
                vec_ids, row_labels = part.column(0).to_numpy(), part.column(1).to_numpy()
                codes = matrix(part.column(2).to_pylist(), "<u8")
                align, rest = part.column(3).to_numpy(), part.column(4).to_numpy()
                x = matrix(part.column(5).to_pylist(), "<f8")
                for start in range(0, len(ids), p.batch_anchors):
                    at = slice(start, start + p.batch_anchors)
                    least, most = queries.intervals(at, codes, align, rest)
                    # the lowest and the highest score that some slot of the anchor still takes
                    easiest = np.where(used[at], reach[at], np.iinfo(np.int64).max).min(axis=1)
                    widest = np.where(used[at], high[at], _LEAST).max(axis=1)
                    same = row_labels[:, None] == labels[at]
                    open_ = (most >= easiest) & (least <= widest)
                    open_ &= same & (vec_ids[:, None] != ids[at]) if same_label else ~same
                    r, a = np.nonzero(open_)
                    score = tile_scores(x, vectors[at], r, a)
                    likely = (score >= easiest[a]) & (score <= widest[a])
                    r, a, score = r[likely], a[likely] + start, score[likely]
                    found: list[list[np.ndarray]] = [[], [], []]
                    for s in range(n_slots):
                        good = used[a, s] & (score >= reach[a, s]) & (score <= high[a, s])
                        for col, v in zip(found, (a[good] * n_slots + s, score[good], vec_ids[r[good]])):
                            col.append(v)
                    hits = [np.concatenate(c) for c in found]
                    if len(hits[0]):
                        best = take(hits)
        yield pa.RecordBatch.from_arrays([
            pa.array(ids[best[0] // n_slots], pa.int64()), pa.array((best[0] % n_slots).astype(np.int32), pa.int32()),
            pa.array(best[2], pa.int64()), pa.array(best[1], pa.int64()),
        ], ["anchor_id", "slot", "vec_id", "score"])

    return index.mapInArrow(scan, _FOUND)


def ranked(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` best of every (anchor_id, slot), with their ``rank``: some rows a task and slot come in."""
    best = Window.partitionBy("anchor_id", "slot").orderBy(F.desc("score"), "vec_id")
    return found.distinct().withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def reached(found: DataFrame, ids: np.ndarray, shape: tuple[int, int], k: int) -> np.ndarray:
    """Per anchor and slot the last of its ``k`` scores, where it has so many (one row a slot reaches the driver)."""
    out = np.full(shape, _LEAST, np.int64)
    rows = found.where(F.col("rank") == k).select("anchor_id", "slot", "score").collect()
    place = {i: n for n, i in enumerate(ids.tolist())}
    for r in rows:
        out[place[r["anchor_id"]], r["slot"]] = r["score"]
    return out


def _block(index: DataFrame, mine: Column) -> dict:
    """One of the blocks of anchors, ordered by vec_id, collected."""
    rows = index.where(mine).groupBy("vec_id").agg(F.min(F.struct("label", "vector")).alias("a")).collect()
    rows.sort(key=lambda r: r["vec_id"])
    return {"ids": np.array([r["vec_id"] for r in rows], np.int64), "labels": np.array([r["a"]["label"] for r in rows], np.int64),
            "vectors": [bytes(r["a"]["vector"]) for r in rows]}


def best_rows(index: DataFrame, anchors: DataFrame, block: dict, k: int, same_label: bool, p: MiningParams) -> DataFrame:
    """The ``k`` best rows of every slot: thresholds from the anchors themselves first, then all rows."""
    first = ranked(search(anchors, block, k, same_label, p), k)
    block = block | {"reach": reached(first, block["ids"], block["low"].shape, k)}
    return ranked(search(index, block, k, same_label, p), k)


def windows(positives: DataFrame, ids: np.ndarray, p: MiningParams) -> tuple[np.ndarray, np.ndarray]:
    """Lowest and highest score allowed for each anchor and positive (at most ``positives`` rows an anchor are collected)."""
    low = np.full((len(ids), p.positives), 1, np.int64)
    high = np.zeros((len(ids), p.positives), np.int64)
    place = {i: n for n, i in enumerate(ids.tolist())}
    for r in positives.collect():
        at = place[r["anchor_id"]], r["rank"] - 1
        low[at], high[at] = -(-p.low_percent * r["score"] // 100), p.high_percent * r["score"] // 100
    return low, high


def hard_negatives(embeddings: DataFrame, params: MiningParams = MiningParams()) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for every anchor and positive."""
    p, spark = params, embeddings.sparkSession
    rows = usable(embeddings)
    anchor = F.pmod("vec_id", F.lit(p.anchor_every)) == 0
    seen = rows.agg(F.max(F.size("embedding")).alias("dim"), F.count(F.when(anchor, 1)).alias("anchors")).first()
    out = spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    if not seen["anchors"]:
        return out
    dim = max(1, seen["dim"])
    index = build_index(rows, dim, p)
    anchors = written(index.where(anchor), "mining-anchors")
    blocks = max(1, math.ceil(seen["anchors"] * 8 * dim * 1.2 / p.block_bytes))
    for number in range(blocks):
        mine = F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == number
        block = _block(anchors, mine)
        n = len(block["ids"])
        if not n:
            continue
        everything = block | {"low": np.full((n, 1), _LEAST), "high": np.full((n, 1), np.iinfo(np.int64).max), "reach": np.full((n, 1), _LEAST)}
        positives = written(best_rows(index, anchors, everything, p.positives, True, p), "mining-positives")
        low, high = windows(positives, block["ids"], p)
        allowed = block | {"low": low, "high": high, "reach": np.full(low.shape, _LEAST)}
        negatives = best_rows(index, anchors, allowed, p.negatives, False, p)
        pairs = positives.select("anchor_id", (F.col("rank") - 1).alias("slot"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
        part = negatives.join(pairs, ["anchor_id", "slot"]).select(
            "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
        out = part if number == 0 else out.union(part)
    return out
