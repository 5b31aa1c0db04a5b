"""Suffix-array dedup: every byte inside a ``window``-byte string that also starts earlier is removed.

Matches are judged on the input (overlaps count, nothing is removed in between) and
never cross documents. Earlier means a smaller doc_id, or an earlier start in the
same document. The result is exact over the whole corpus without one array over it:

1. **Anchors.** The anchor of a window is its ``gram``-byte substring with the smallest
   hash (the rightmost of equals): a function of the window's bytes alone, so equal
   windows have equal anchors at the same offset. Neighbouring windows mostly share
   an anchor, so a document gives one row per anchor: its hash, the range of windows
   it stands for and a hash of the bytes they cover (the context).
2. **Whole contexts.** Rows are dealt out by anchor. Anchors that occur once, nearly
   all of unrepeated text, end here. Of equal contexts all but the first are covered
   in full: the inside of copies and repeated passages needs no text at all.
   Contexts that a text repeats inside itself are settled before anything is sent.
3. **Shards.** What remains are first contexts with an anchor that other contexts
   share: the edges of repeats, and common short phrases. Their windows are cut in
   bands; all windows of a band share a core of bytes, and bands are dealt out by the
   hash of their core, so equal windows meet. Equal bands settle each other as
   contexts do. A task lays the other bands of several cores
   out as one shard text and builds its suffix array by induced sorting and the
   permuted common prefixes (``llm.sais``): suffixes of common prefix ``window`` or more
   stand next to each other, and all but the first of such a run are covered.
4. **Hot cores.** A core that more than ``hot`` contexts share is not put into one
   task: its windows are dealt out one by one by their own hash.
5. Covered ranges are merged per document and cut out.

Defined cases: null text is empty; texts under ``window`` bytes keep everything; rows of
equal doc_id are ordered by a hash of their text, and equal rows count as one
document (each gets the same result); a null doc_id is the smallest; an empty table
gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .bytesops import flat_ranges, mix, prefix_hash, span_hash, text_chunks
from .registry import written
from .sais import permuted_lcp, suffix_array

_FIRST = np.uint64(0xC2B2AE3D27D4EB4F)


@dataclass(frozen=True)
class SuffixParams:
    """Production parameters."""

    window: int = 100
    gram: int = 32
    band: int = 23
    shard_bytes: int = 1 << 16
    hot: int = 2000


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours, by doubling."""
    span = 1
    while span * 2 <= width:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    rest = width - span
    return np.minimum(x[: len(x) - rest], x[rest:]) if rest else x


def anchors(data: np.ndarray, offsets: np.ndarray, p: SuffixParams) -> tuple[np.ndarray, ...]:
    """Per anchor of the texts of a chunk: (text, anchor hash, context hash, first and last window, anchor place)."""
    empty = np.zeros(0, np.int64)
    if len(data) < p.window:
        return empty, empty, empty, empty, empty, empty
    prefix = prefix_hash(data)
    at = np.arange(len(data) - p.gram + 1)
    grams = span_hash(prefix, at, at + p.gram)
    # smallest hash first, then the rightmost place (32 bits each)
    ranked = (grams & np.uint64(0xFFFFFFFF00000000)) | (np.uint64(0xFFFFFFFF) - at.astype(np.uint64))
    least = _sliding_min(ranked, p.window - p.gram + 1)  # one per window start
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[: len(least)]
    inside = np.flatnonzero(np.arange(len(least)) + p.window <= offsets[text + 1])
    if not len(inside):
        return empty, empty, empty, empty, empty, empty
    place = (np.uint64(0xFFFFFFFF) - (least[inside] & np.uint64(0xFFFFFFFF))).astype(np.int64)
    begin = np.ones(len(inside), bool)
    begin[1:] = (place[1:] != place[:-1]) | (inside[1:] != inside[:-1] + 1)
    runs = np.flatnonzero(begin)
    lo, hi, where = inside[runs], inside[np.append(runs[1:], len(inside)) - 1], place[runs]
    context = mix(span_hash(prefix, lo, hi + p.window) ^ (where - lo + 1).astype(np.uint64) * _FIRST)
    return text[lo], grams[where].view(np.int64), context.view(np.int64), lo, hi, where


def settle_inside(text: np.ndarray, ah: np.ndarray, ch: np.ndarray, lo: np.ndarray, hi: np.ndarray, place: np.ndarray, p: SuffixParams):
    """Contexts that a text repeats are covered by their first place in it: they become covered ranges.

    A range is a row with place -1 and a hash of its own, so text of a short period
    sends a row per run, not a row per period, and none of them to the same place.
    """
    if not len(text):
        return text, ah, ch, lo, hi, place
    key = mix(mix(ah.view(np.uint64) + text.astype(np.uint64) * _FIRST) + ch.view(np.uint64))
    once = np.zeros(len(text), bool)
    once[np.unique(key, return_index=True)[1]] = True
    at = np.flatnonzero(~once)
    if not len(at):
        return text, ah, ch, lo, hi, place
    begin = np.ones(len(at), bool)
    begin[1:] = (text[at[1:]] != text[at[:-1]]) | (lo[at[1:]] > hi[at[:-1]] + p.window)
    runs = np.flatnonzero(begin)
    first, last = at[runs], at[np.append(runs[1:], len(at)) - 1]
    own = mix(key[first] + lo[first].astype(np.uint64) * _FIRST).view(np.int64)
    return tuple(np.concatenate([x[once], y]) for x, y in (
        (text, text[first]), (ah, own), (ch, own), (lo, lo[first]), (hi, hi[last]), (place, np.full(len(first), -1))))


def anchor_rows(docs: DataFrame, p: SuffixParams) -> DataFrame:
    """(ah, ch, doc_id, rank, lo, hi, place): one row per anchor; places are offsets in the text.

    Rows with place -1 are ranges that ``settle_inside`` found covered.
    """
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for first, end, data, offsets in text_chunks(b.column(2)):
                text, ah, ch, lo, hi, place = settle_inside(*anchors(data, offsets, p), p)
                start = offsets[text] if len(text) else text
                rows = pa.array(text + first)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ah), pa.array(ch), b.column(0).take(rows), b.column(1).take(rows), *(pa.array(x.astype(np.int32)) for x in (lo - start, hi - start, np.where(place < 0, -1, place - start)))],
                    ["ah", "ch", "doc_id", "rank", "lo", "hi", "place"],
                )

    return docs.select("doc_id", "rank", "text").mapInArrow(make, "ah long, ch long, doc_id long, rank int, lo int, hi int, place int")


def _position(start: str = "lo") -> Column:
    return F.struct("doc_id", "rank", F.col(start).alias("start"))


def band_rows(docs: DataFrame, wanted: DataFrame, p: SuffixParams) -> DataFrame:
    """(core, bh, doc_id, rank, lo, body): the bands of the wanted contexts, the bytes of their windows and a hash of them."""
    reach = p.window - p.gram

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["core", "bh", "doc_id", "rank", "lo", "body"]
        for b in batches:
            for row in range(b.num_rows):
                raw = (b.column("text")[row].as_py() or "").encode()
                prefix = prefix_hash(np.frombuffer(raw, np.uint8))
                contexts = b.column("contexts")[row].values
                lo, hi, place = (contexts.field(c).to_numpy().astype(np.int64) for c in ("lo", "hi", "place"))
                first, last = (lo - place + reach) // p.band, (hi - place + reach) // p.band
                n = last - first + 1
                lo, hi, place = (np.repeat(x, n) for x in (lo, hi, place))
                edge = place - reach + p.band * flat_ranges(first, n)  # first window of each band
                core = mix(span_hash(prefix, edge + p.band - 1, edge + p.window))
                begin, end = np.maximum(lo, edge), np.minimum(hi, edge + p.band - 1) + p.window
                body = span_hash(prefix, begin, end)
                m = len(edge)
                yield pa.RecordBatch.from_arrays([
                    pa.array(core.view(np.int64)), pa.array(body.view(np.int64)),
                    pa.array([b.column("doc_id")[row].as_py()] * m, pa.int64()), pa.array([b.column("rank")[row].as_py()] * m, pa.int32()),
                    pa.array(begin.astype(np.int32)), pa.array([raw[a:z] for a, z in zip(begin.tolist(), end.tolist())], pa.binary()),
                ], names)

    lists = wanted.groupBy(F.col("doc_id").alias("_d"), F.col("rank").alias("_r")).agg(F.collect_list(F.struct("lo", "hi", "place")).alias("contexts"))
    joined = docs.join(lists, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("rank") == F.col("_r"))).select("doc_id", "rank", "text", "contexts")
    return joined.mapInArrow(make, "core long, bh long, doc_id long, rank int, lo int, body binary")


def repeated_starts(bodies: list[bytes], order: list[tuple], window: int) -> list[list[int]]:
    """Per body, the offsets of windows that occur earlier; ``order`` gives each body's (doc, rank, start) position."""
    sizes = np.array([len(b) for b in bodies])
    ends = np.cumsum(sizes + 1) - 1
    firsts = ends - sizes
    text = np.zeros(int(ends[-1]) + 1, np.int64)  # 0 ends each body
    for f, b in zip(firsts, bodies):
        text[f : f + len(b)] = np.frombuffer(b, np.uint8).astype(np.int64) + 1
    owner = np.repeat(np.arange(len(bodies)), sizes + 1)
    sa = suffix_array(text)
    lcp = permuted_lcp(text, sa, ends[owner], window)[sa]
    out: list[list[int]] = [[] for _ in bodies]
    joined = np.flatnonzero(lcp >= window)
    if not len(joined):
        return out
    for run in np.split(joined, np.flatnonzero(np.diff(joined) > 1) + 1):
        spots = []
        for i in sa[run[0] - 1 : run[-1] + 1].tolist():
            body = int(owner[i])
            offset = i - int(firsts[body])
            doc, rank, lo = order[body]
            spots.append(((doc is not None, doc or 0, rank, lo + offset), body, offset))
        least = min(s[0] for s in spots)
        for spot, body, offset in spots:
            if spot != least:
                out[body].append(offset)
    return out


def shard_ranges(bands: DataFrame, p: SuffixParams) -> DataFrame:
    """(doc_id, rank, lo, end): covered ranges found by the suffix arrays of the shards."""
    names = ["doc_id", "rank", "lo", "end"]

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard: list[tuple] = []  # whole groups of equal cores
        group: list[tuple] = []
        size = 0

        def covered() -> pa.RecordBatch:
            cols: list[list] = [[], [], [], []]
            starts = repeated_starts([r[4] for r in shard], [r[1:4] for r in shard], p.window)
            for (_, doc_id, rank, lo, _), offsets in zip(shard, starts):
                end = -1
                for o in sorted(offsets):
                    if o > end:  # windows further apart than their length make ranges of their own
                        for c, v in zip(cols, (doc_id, rank, lo + o, 0)):
                            c.append(v)
                    end = o + p.window
                    cols[3][-1] = lo + end
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int32(), pa.int32()))], names)

        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns)):
                if group and row[0] != group[0][0]:
                    if len(group) > 1:
                        shard += group
                        size += sum(len(r[4]) for r in group)
                    group = []
                    if size >= p.shard_bytes:
                        yield covered()
                        shard, size = [], 0
                group.append(row)
        if len(group) > 1:
            shard += group
        if shard:
            yield covered()

    # a fixed number of tasks: the work is in the arrays, so few bytes must not mean few tasks
    tasks = int(bands.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return bands.repartition(tasks, "core").sortWithinPartitions("core").mapInArrow(make, "doc_id long, rank int, lo int, end int")


def hot_ranges(bands: DataFrame, p: SuffixParams) -> DataFrame:
    """The same for cores shared by many contexts: every window is dealt out by its own bytes."""
    at = F.explode(F.sequence(F.lit(0), F.octet_length("body") - p.window))
    rows = bands.select("doc_id", "rank", "lo", "body", at.alias("o"))
    cut = F.substring("body", F.col("o") + 1, F.lit(p.window))
    rows = rows.select("doc_id", "rank", (F.col("lo") + F.col("o")).alias("lo"), F.xxhash64(cut).alias("h1"), F.xxhash64(F.lit(1), cut).alias("h2"))
    least = rows.groupBy(F.col("h1").alias("_1"), F.col("h2").alias("_2")).agg(F.min(_position()).alias("first"))
    return rows.join(least, (F.col("h1") == F.col("_1")) & (F.col("h2") == F.col("_2"))).where(_position() > F.col("first")).select(
        "doc_id", "rank", "lo", (F.col("lo") + p.window).alias("end"))


def merge_ranges(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Disjoint, not touching ranges that cover the same."""
    out: list[list[int]] = []
    for a, z in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], z)
        else:
            out.append([a, z])
    return [(a, z) for a, z in out]


def ranked(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) with ``rank``: 0, or the place among different texts of one doc_id.

    Doc_ids that occur twice are few; they are written first, so Spark knows their
    size and need not shuffle the texts to attach ranks.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    again = texts.groupBy("doc_id").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select(F.col("doc_id").alias("_d"))
    several = written(
        texts.join(written(again, "suffix-again"), F.col("doc_id").eqNullSafe(F.col("_d"))).select("doc_id", F.xxhash64("text").alias("th")).distinct(), "suffix-several"
    )
    ranks = several.select(
        F.col("doc_id").alias("_d"), F.col("th").alias("_t"),
        (F.row_number().over(Window.partitionBy("doc_id").orderBy("th")) - 1).cast("int").alias("rank"),
    )
    ranks = written(ranks, "suffix-ranks")
    return texts.join(ranks, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.xxhash64("text") == F.col("_t")), "left").select(
        "doc_id", F.coalesce("rank", F.lit(0)).alias("rank"), "text")


def covered_ranges(docs: DataFrame, p: SuffixParams) -> DataFrame:
    """(doc_id, rank, lo, end) of covered ranges; ``docs`` is ranked."""
    same, group = Window.partitionBy("ah", "ch"), Window.partitionBy("ah")
    rows = (
        anchor_rows(docs, p).withColumn("first", F.min(_position()).over(same))
        .withColumn("_n", F.count(F.lit(1)).over(group)).withColumn("_lo", F.min("ch").over(group)).withColumn("_hi", F.max("ch").over(group))
        .where("_n > 1 or place < 0").select(
            "doc_id", "rank", "lo", "hi", "place", ((_position() > F.col("first")) | (F.col("place") < 0)).alias("later"), (F.col("_lo") != F.col("_hi")).alias("mixed"))
    )
    rows = written(rows.where("later or mixed"), "suffix-anchors")
    whole = rows.where("later").select("doc_id", "rank", "lo", (F.col("hi") + p.window).alias("end"))
    wanted = rows.where("mixed and not later").dropDuplicates(["doc_id", "rank", "lo"])
    # equal bands settle each other in the same way: only different bands of one core are left for the arrays
    equal, core = Window.partitionBy("core", "bh"), Window.partitionBy("core")
    bands = (
        band_rows(docs, wanted, p).withColumn("first", F.min(_position()).over(equal))
        .withColumn("_lo", F.min("bh").over(core)).withColumn("_hi", F.max("bh").over(core)).withColumn("later", _position() > F.col("first"))
        .withColumn("n", F.sum(F.when(F.col("later"), 0).otherwise(1)).over(core)).where("later or _lo <> _hi")
        .select("core", "doc_id", "rank", "lo", F.when(F.col("later"), F.lit(None)).otherwise(F.col("body")).alias("body"),
                (F.col("lo") + F.octet_length("body")).alias("end"), "later", "n")
    )
    bands = written(bands, "suffix-bands")
    again = bands.where("later").select("doc_id", "rank", "lo", "end")
    open_bands = bands.where("not later").select("core", "doc_id", "rank", "lo", "body", "n")
    cold, hot = open_bands.where(F.col("n") <= p.hot).drop("n"), open_bands.where(F.col("n") > p.hot)
    return whole.union(again).union(shard_ranges(cold, p)).union(hot_ranges(hot, p))


def suffix_dedup(docs: DataFrame, params: SuffixParams = SuffixParams()) -> DataFrame:
    """(doc_id, n_bytes, kept, spans): the bytes that stay, and the removed runs, of every row of ``docs`` (doc_id, text)."""
    source = ranked(docs)
    ranges = covered_ranges(source, params).groupBy(F.col("doc_id").alias("_d"), F.col("rank").alias("_r")).agg(
        F.collect_set(F.struct("lo", "end")).alias("ranges"))
    joined = source.join(ranges, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("rank") == F.col("_r")), "left").select("doc_id", "text", "ranges")
    spans_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes, kept, spans = [], [], []
            for text, ranges in zip(b.column(1), b.column(2)):
                raw = (text.as_py() or "").encode()
                runs = merge_ranges([(r["lo"], r["end"]) for r in ranges.as_py()]) if ranges.is_valid else []
                edges = [0, *(x for r in runs for x in r), len(raw)]
                sizes.append(len(raw))
                kept.append(b"".join(raw[a:z] for a, z in zip(edges[::2], edges[1::2])))
                spans.append([{"start": a, "end": z} for a, z in runs])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(sizes, pa.int64()), pa.array(kept, pa.binary()), pa.array(spans, spans_type)], ["doc_id", "n_bytes", "kept", "spans"])

    return joined.mapInArrow(cut, "doc_id long, n_bytes long, kept binary, spans array<struct<start:long,end:long>>")
