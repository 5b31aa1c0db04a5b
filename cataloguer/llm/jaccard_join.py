"""N-gram Jaccard join: links of all texts whose shingle sets have Jaccard similarity >= ``percent``.

Exact, in three layers, all Spark joins:

1. **Classes.** Texts with the same set form a class (64-bit digest); only classes are
   joined. Copies cost one row each.
2. **Regions.** Unrelated sets all lie at Jaccard distance about 1 from any pivot, so
   regions around pivot texts alone would hold everything (the window of the
   triangle inequality is as wide as the space). So the space is first cut exactly:
   for sizes in a window, linked sets differ in at most ``t`` shingles; the shingles
   are dealt by hash to ``t + 1 + spare`` slices, so linked sets agree on at least
   ``spare + 1`` slices. A region is the group of classes with the same slice
   (window, slice number, content). Slices of fewer than ``weak`` shingles are left out
   if a set has at most ``spare`` of them; a set with more also uses further
   dealings (other hash seeds), which its linked sets in the same state use too.
   Common lines and passages thus make no large region: a slice is equal only if all
   its shingles, from anywhere in the text, are.
3. **Pivots and windows.** The class that occurs in most regions is a region's pivot,
   and exact distances to it are computed; classes within the radius are linked to
   it (a star, not all pairs). Regions whose classes are by then one component are
   done. Each class now belongs to the Voronoi region of the nearest pivot it was
   measured against, and two classes of one region can be linked only if their
   distances to the pivot differ by at most the radius (triangle inequality).
4. **Boundary.** What is left is joined once more by windows over shingles: the
   shingles of the classes left are ranked, rarest first, and a class is replicated to
   the regions of its first ``(1 - s) n + 1`` shingles, in which it must meet any
   linked class. In a region only pairs of different components are compared whose
   sizes, places in the ranking and distances to a common pivot allow a link. A
   shingle that a text shares with no other fills a place of its window and meets
   nobody, so families of texts that are all edited too far apart end here without
   being compared.

Components follow from the links found (``llm.components``). Links inside one
component that are not needed to connect it are not computed.

Defined cases: null text, or text without words, has an empty set and is linked with
nothing; a text with fewer words than a shingle is one shingle of all its words;
repeated rows are copies of one class; an empty table gives no rows; a null doc_id
stays null and is never a component's smallest id unless it is alone; other columns
are not read.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bytesops import mix, prefix_hash, span_hash, text_chunks
from .components import components
from .registry import written

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_K = np.array([0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], np.uint64)  # factors wrap modulo 2^64


@dataclass(frozen=True)
class JaccardParams:
    """Production parameters."""

    percent: int = 85
    words: int = 4
    growth: float = 1.4  # ratio of the size windows
    weak: int = 2  # slices of fewer shingles are left out
    seeds: int = 8  # dealings for sets with many weak slices


class Windows:
    """Size windows: pairs whose smaller set lies in window w are found with w's slices."""

    def __init__(self, params: JaccardParams):
        self.p = params.percent
        self.bounds = [1]
        while self.bounds[-1] < 1 << 40:
            self.bounds.append(max(self.bounds[-1] + 1, int(self.bounds[-1] * params.growth)))

    def differ(self, w: int) -> int:
        """Most shingles in which linked sets of the window can differ: union <= x / s, so at most (1 - s) x / s."""
        return (100 - self.p) * (self.bounds[w + 1] - 1) // self.p

    def of(self, n: int) -> list[int]:
        """Windows in which a set of n shingles takes part, as the smaller or the larger one."""
        w = bisect.bisect_right(self.bounds, n) - 1
        out = [w]
        while w > 0 and self.p * n <= 100 * (self.bounds[w] - 1):
            w -= 1
            out.append(w)
        return out


def shingle_sets(data: np.ndarray, offsets: np.ndarray, words: int) -> Iterator[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text of a chunk (lower-cased A-Z, white-space words)."""
    data = _FOLD[data]
    n = len(offsets) - 1
    if not len(data):
        yield from (np.zeros(0, np.uint64) for _ in range(n))
        return
    word = ~_BLANK[data]
    edge = word[1:] != word[:-1]
    first = np.zeros(len(data), bool)
    first[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
    begin = word & first
    begin[1:] |= word[1:] & ~word[:-1]
    starts = np.flatnonzero(begin)
    stop = np.zeros(len(data) + 1, bool)
    stop[1:-1] = word[:-1] & (edge & ~word[1:] | first[1:])
    stop[-1] = word[-1]
    ends = np.flatnonzero(stop)
    h = span_hash(prefix_hash(data), starts, ends, data)
    at = np.searchsorted(starts, offsets)
    grams = h[: max(0, len(h) - words + 1)].copy()
    for k in range(1, words):
        grams = mix(grams * _K[0] + h[k : k + len(grams)])
    for i in range(n):
        a, b = int(at[i]), int(at[i + 1])
        if b - a >= words:
            yield np.unique(grams[a : b - words + 1])
        elif b > a:
            g = h[a : a + 1] + _K[1:2] * np.uint64(b - a)
            for k in range(a + 1, b):
                g = mix(g * _K[:1] + h[k : k + 1])
            yield g
        else:
            yield np.zeros(0, np.uint64)


def slice_keys(s: np.ndarray, windows: Windows, seeds: int, weak: int = 2) -> np.ndarray:
    """Region keys of a set (see the module)."""
    out = []
    for w in windows.of(len(s)):
        t = windows.differ(w)
        if not t:
            continue  # linked sets are equal: one class
        spare = 1 + (t + 1) // 8
        m = t + 1 + spare
        for r in range(seeds):
            at = (mix(s ^ _K[2:3] * np.uint64(r + 1)) % np.uint64(m)).astype(np.int64)
            total = np.zeros(m, np.uint64)
            np.add.at(total, at, mix(s + _K[3]))
            strong = np.bincount(at, minlength=m) >= weak
            enough = m - int(strong.sum()) <= spare
            where = np.flatnonzero(strong) if enough or r < seeds - 1 else np.arange(m)
            out.append(mix(mix(total[where] + where.astype(np.uint64) * _K[0]) + np.uint64(w * 64 + r) * _K[1:2]))
            if enough:
                break
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def _as_lists(arrays: list[np.ndarray]) -> pa.Array:
    flat = np.concatenate([*arrays, np.zeros(0, np.uint64)]).view(np.int64)
    offsets = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))


def _digest(s: np.ndarray) -> int:
    return int((mix(s + _K[3]).sum(dtype=np.uint64, keepdims=True) + _K[1:2] * np.uint64(len(s))).view(np.int64)[0]) if len(s) else 0


def keyed_sets(docs: DataFrame, params: JaccardParams) -> DataFrame:
    """(doc_id, n, cls, keys): set size, class digest and region keys of every text.

    A class already met in the same task gives no keys again.
    """
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows, met = Windows(params), set()
        for b in batches:
            for lo, hi, data, offsets in text_chunks(b.column(1)):
                sizes, classes, keys = [], [], []
                for s in shingle_sets(data, offsets, params.words):
                    c = _digest(s)
                    sizes.append(len(s))
                    classes.append(c)
                    keys.append(np.zeros(0, np.uint64) if c in met else slice_keys(s, windows, params.seeds, params.weak))
                    met.add(c)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, hi - lo), pa.array(sizes, pa.int64()), pa.array(classes, pa.int64()), _as_lists(keys)],
                    ["doc_id", "n", "cls", "keys"],
                )

    return docs.mapInArrow(make, "doc_id long, n long, cls long, keys array<long>")


def class_sets(docs: DataFrame, params: JaccardParams) -> DataFrame:
    """(cls, shingles): the whole set of each text of ``docs`` (doc_id, text)."""
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for _, _, data, offsets in text_chunks(b.column(1)):
                sets = list(shingle_sets(data, offsets, params.words))
                yield pa.RecordBatch.from_arrays([pa.array([_digest(s) for s in sets], pa.int64()), _as_lists(sets)], ["cls", "shingles"])

    return docs.mapInArrow(make, "cls long, shingles array<long>")


class _Joiner:
    """State of one join: exact distances known so far and the components they give."""

    def __init__(self, regions: DataFrame, info: DataFrame, sets: DataFrame, params: JaccardParams):
        self.p, self.sets = params, sets
        # (key, cls, n, pop): pop is the number of regions a class occurs in
        pop = regions.groupBy("cls").agg(F.count(F.lit(1)).alias("pop")).join(info, "cls")
        self.regions = written(regions.join(pop, "cls").select("key", "cls", "n", "pop"), "jaccard-regions")
        self.known: DataFrame | None = None  # (a, b, common, na, nb), a < b
        self.labels: DataFrame | None = None  # (node, root)

    def measure(self, pairs: DataFrame) -> None:
        """Exact common-shingle counts of new pairs (a, b); then the components again."""
        if self.known is not None:
            pairs = pairs.join(self.known.select("a", "b"), ["a", "b"], "left_anti")
        one = self.sets.select(F.col("cls").alias("a"), F.col("shingles").alias("sa"))
        two = self.sets.select(F.col("cls").alias("b"), F.col("shingles").alias("sb"))
        counted = pairs.join(one, "a").join(two, "b").select(
            "a", "b", F.size(F.array_intersect("sa", "sb")).cast("long").alias("common"),
            F.size("sa").cast("long").alias("na"), F.size("sb").cast("long").alias("nb"),
        )
        fresh = written(counted, "jaccard-pairs")
        linked = (100 + self.p.percent) * F.col("common") >= self.p.percent * (F.col("na") + F.col("nb"))
        self.known = fresh if self.known is None else self.known.union(fresh)
        if self.labels is None or not fresh.where(linked).isEmpty():
            links = self.known.where(linked).select(F.col("a").alias("u"), F.col("b").alias("v"))
            self.labels = written(components(links), "jaccard-labels")

    def labelled(self, regions: DataFrame) -> DataFrame:
        """Regions with each class's component, without those that are settled.

        A region is settled if it is one component, or, once measured against its pivot, has two classes only.
        """
        if self.labels is None:
            return regions.withColumn("comp", F.col("cls"))
        rows = regions.join(self.labels.withColumnRenamed("node", "cls"), "cls", "left").withColumn("comp", F.coalesce("root", "cls")).drop("root")
        w = Window.partitionBy("key")
        return (
            rows.withColumn("_lo", F.min("comp").over(w)).withColumn("_hi", F.max("comp").over(w)).withColumn("_n", F.count(F.lit(1)).over(w))
            .where("_lo <> _hi and _n > 2").drop("_lo", "_hi", "_n")
        )

    def possible(self, n: str, m: str):
        """Whether sizes allow a link."""
        return 100 * F.least(n, m) >= self.p.percent * F.greatest(n, m)

    @staticmethod
    def ordered(rows: DataFrame, x: str, y: str) -> DataFrame:
        return rows.select(F.least(x, y).alias("a"), F.greatest(x, y).alias("b")).distinct()

    def star(self, regions: DataFrame) -> None:
        """Measure each class of a region against the region's most frequent class."""
        pivot = F.max(F.struct("pop", "cls", "n", "comp")).over(Window.partitionBy("key"))
        self.pivots = written(regions.groupBy("key").agg(F.max(F.struct("pop", "cls")).alias("p")).select(F.col("p.cls").alias("pivot")).distinct(), "jaccard-pivots")
        rows = regions.withColumn("pivot", pivot).where(F.col("comp") != F.col("pivot.comp")).select(
            "cls", "n", F.col("pivot.cls").alias("p"), F.col("pivot.n").alias("pn")
        )
        self.measure(self.ordered(rows.where(self.possible("n", "pn")), "cls", "p"))

    def homes(self) -> DataFrame:
        """(cls, home, d): the nearest pivot each class was measured against, and the distance to it."""
        d = 1 - F.col("common") / (F.col("na") + F.col("nb") - F.col("common"))
        k = self.known.select("a", "b", d.alias("d"))
        both = k.select(F.col("a").alias("cls"), F.col("b").alias("home"), "d").union(k.select(F.col("b").alias("cls"), F.col("a").alias("home"), "d"))
        near = both.join(self.pivots, both["home"] == self.pivots["pivot"], "left_semi").groupBy("cls").agg(F.min(F.struct("d", "home")).alias("h"))
        own = self.pivots.select(F.col("pivot").alias("cls"), F.col("pivot").alias("home"), F.lit(0.0).alias("d"))
        return near.select("cls", "h.home", "h.d").join(own.select("cls"), "cls", "left_anti").union(own)

    def boundary(self, left: DataFrame) -> None:
        """Measure the pairs of different components that windows over the rarest shingles bring together."""
        radius = 1 - self.p.percent / 100
        classes = left.select("cls", "n", "comp").distinct().join(self.homes(), "cls", "left")
        w = Window.partitionBy("g")
        # narrow rows, one shuffle: a shingle of one class only counts for the places it takes
        rows = self.sets.join(classes.select("cls"), "cls", "left_semi").select("cls", F.explode("shingles").alias("g"))
        shared = rows.withColumn("df", F.count(F.lit(1)).over(w)).where("df > 1")
        own = Window.partitionBy("cls")
        ranked = shared.withColumn("rank", F.row_number().over(own.orderBy("df", "g"))).withColumn("many", F.count(F.lit(1)).over(own))
        window = F.floor((100 - self.p.percent) * F.col("n") / 100) + 1
        met = written(
            ranked.join(classes, "cls").withColumn("pos", F.col("n") - F.col("many") + F.col("rank")).where(F.col("pos") <= window)
            .withColumn("_lo", F.min("comp").over(w)).withColumn("_hi", F.max("comp").over(w)).where("_lo <> _hi")
            .select("g", "cls", "n", "comp", "home", "d", "pos"),
            "jaccard-boundary",
        )
        other = met.select("g", *[F.col(c).alias(f"_{c}") for c in ("cls", "n", "comp", "home", "d", "pos")])
        needed = F.ceil(self.p.percent * (F.col("n") + F.col("_n")) / (100 + self.p.percent))
        apart = (F.col("home") == F.col("_home")) & (F.abs(F.col("d") - F.col("_d")) > radius + 1e-9)
        pairs = met.join(other, "g").where(
            (F.col("cls") < F.col("_cls")) & (F.col("comp") != F.col("_comp")) & self.possible("n", "_n") & ~F.coalesce(apart, F.lit(False))
            & (1 + F.least(F.col("n") - F.col("pos"), F.col("_n") - F.col("_pos")) >= needed)
        )
        self.measure(self.ordered(pairs, "cls", "_cls"))


def jaccard_join(docs: DataFrame, params: JaccardParams = JaccardParams()) -> DataFrame:
    """(doc_id, n_shingles, component_id, class_id) of every row of ``docs`` (doc_id, text)."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    keyed = written(keyed_sets(texts, params), "jaccard-keys")
    classes = keyed.where("n > 0").groupBy("cls").agg(F.min("doc_id").alias("least"), F.first("n").alias("n"))
    w = Window.partitionBy("key")
    regions = (
        keyed.select("cls", F.explode_outer("keys").alias("key")).where(F.col("key").isNotNull())
        .withColumn("_lo", F.min("cls").over(w)).withColumn("_hi", F.max("cls").over(w)).where("_lo <> _hi")
        .select("key", "cls").distinct()
    )
    regions = written(regions, "jaccard-shared")
    wanted = regions.select("cls").distinct().join(classes, "cls").select(F.col("least").alias("_id"))
    sets = written(class_sets(texts.join(wanted, F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi"), params).distinct(), "jaccard-sets")
    join = _Joiner(regions, classes.select("cls", "n"), sets, params)
    join.star(join.labelled(join.regions))
    left = written(join.labelled(join.regions), "jaccard-left")
    if not left.isEmpty():
        join.boundary(left)
    roots = classes.join(join.labels.withColumnRenamed("node", "cls"), "cls", "left").withColumn("root", F.coalesce("root", "cls"))
    least = roots.groupBy("root").agg(F.min("least").alias("component_id"))
    named = roots.join(least, "root").select("cls", "component_id")
    return keyed.select("doc_id", F.col("n").alias("n_shingles"), "cls").join(named, "cls", "left").select(
        "doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        F.col("cls").alias("class_id"),
    )
