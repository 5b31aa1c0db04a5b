"""Packing: mixture-controlled sequences by deficit round-robin over source queues.

Every source is a queue of documents. In round ``r`` each source may send its
quantum ``window * share``; what a whole number of ids cannot express stays as
its deficit and counts in the next round. With shares fixed, the ids a source has
sent after ``r`` rounds are ``floor(r * window * share + 1/2)``: the deficits of any
round follow from that count, so a task anywhere in the corpus continues the
rounds, and their deficits, from the queue positions of its documents alone.
The rounds, one after the other, form one gapless stream of ids, cut every
``window`` ids. So all sequences but the last are full, and each holds the target
proportions up to a few ids per source.

Without ``weights`` the shares are the sources' parts of all ids, and all queues
end together. With weights a queue that ends leaves its share to the others in
proportion (a new phase of rounds); nothing is dropped.

Documents are tokenised once and written with their place in the queue of their
task (a table in the shared folder), so a lost executor repeats only tasks. The
place of each (source, task) queue comes from a window over one row per
(source, task); the only thing gathered on the driver is one total per queue.
``max_sources`` bounds the queues: of more sources the largest keep a queue each and
all others share the last one, one source after the other, with their shares added up.
Nothing is dropped, and the pieces keep their sources' names.

Defined cases: null or empty text holds only the end id; a null source is a source
of its own; repeated rows are packed each; an empty table gives no pieces; other
columns are not read.
"""

from __future__ import annotations

import bisect
import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bpe import default_vocabulary, word_encoder
from .registry import written

_IDS = "doc_id long, source string, part long, before long, n long, ids binary"
_PIECES = "doc_id long, source string, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


@dataclass
class Rounds:
    """The rounds in closed form. Whole numbers throughout, so any task computes the same."""

    totals: list[int]
    weights: list[int]
    window: int
    phases: list[tuple[int, list[int], list[int], int]] = field(default_factory=list)  # first round, sent, live weights, their sum

    def __post_init__(self):
        sent, first = [0] * len(self.totals), 0
        while True:
            live = [w if s < t else 0 for w, s, t in zip(self.weights, sent, self.totals)]
            if not any(live):
                break
            total = sum(live)
            self.phases.append((first, sent, live, total))
            rounds = min(-(-2 * (t - s) * total // (2 * self.window * w)) for w, s, t in zip(live, sent, self.totals) if w)
            rounds = max(1, rounds)
            sent = [self._after(s, w, total, t, rounds) for s, w, t in zip(sent, live, self.totals)]
            first += rounds
        self.phases.append((first, sent, [0] * len(sent), 1))
        self._starts = [p[0] for p in self.phases]
        self._known: dict[int, tuple[list[int], list[int]]] = {}

    def _after(self, sent: int, weight: int, total: int, limit: int, rounds: int) -> int:
        return min(limit, sent + (2 * rounds * self.window * weight + total) // (2 * total))

    def sent(self, r: int) -> list[int]:
        """Ids each source has sent before round ``r``."""
        first, sent, live, total = self.phases[bisect.bisect_right(self._starts, r) - 1]
        return [self._after(s, w, total, t, r - first) if w else s for s, w, t in zip(sent, live, self.totals)]

    def round_of(self, source: int, position: int) -> int:
        """The round that sends the id at ``position`` of a source's queue."""
        k = bisect.bisect_right([p[1][source] for p in self.phases], position) - 1
        first, sent, live, total = self.phases[k]
        w = live[source]
        # smallest rounds with floor((2 r window w + total) / (2 total)) > position - sent
        need = 2 * total * (position - sent[source] + 1) - total
        return first + -(-need // (2 * self.window * w)) - 1

    def layout(self, r: int) -> tuple[list[int], list[int]]:
        """Per source: queue position at the start of round ``r``, and its place in the whole stream."""
        if r not in self._known:
            if len(self._known) > min(100_000, 2_000_000 // max(1, len(self.totals))):
                self._known.clear()
            now, then = self.sent(r), self.sent(r + 1)
            at, place = sum(now), []
            for a, b in zip(now, then):
                place.append(at)
                at += b - a
            self._known[r] = (now, place, then)
        return self._known[r]

    def cut(self, source: int, start: int, n: int) -> Iterator[tuple[int, int, int]]:
        """Pieces (offset in the span, length, place in the stream) of ids [start, start + n) of a queue."""
        done, r = 0, self.round_of(source, start)
        while done < n:
            now, place, then = self.layout(r)
            at = place[source] + start + done - now[source]
            take = min(n - done, then[source] - start - done)
            while take > 0:  # a round may cross the end of a sequence
                here = min(take, self.window - at % self.window)
                yield done, here, at
                done, at, take = done + here, at + here, take - here
            r += 1


def _id_type(vocabulary: str, end_id: int) -> str:
    """Little-endian unsigned type that holds every id of the vocabulary."""
    from tokenizers import Tokenizer

    top = max([end_id, *Tokenizer.from_file(vocabulary).get_vocab(with_added_tokens=True).values()])
    return "<u2" if top < 1 << 16 else "<u4"


def tokenised(docs: DataFrame, vocabulary: str, end_id: int, id_type: str) -> DataFrame:
    """Ids of every document, with its place (``before``) in its source's queue inside the task (``part``)."""
    names = [c.split()[0] for c in _IDS.split(", ")]
    width = np.dtype(id_type).itemsize

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, encoder, queue = TaskContext.get().partitionId(), word_encoder(vocabulary), {}
        end = np.array([end_id], id_type).tobytes()
        for b in batches:
            for lo, hi, ids, counts in encoder.encode(b.column(2)):
                raw = ids.astype(id_type).tobytes()
                stop = (width * np.cumsum(counts)).tolist()
                sizes = (counts + 1).tolist()
                source = b.column(1).slice(lo, hi - lo)
                before = []
                for s, n in zip(source.to_pylist(), sizes):
                    before.append(queue.get(s, 0))
                    queue[s] = before[-1] + n
                yield pa.RecordBatch.from_arrays([
                    b.column(0).slice(lo, hi - lo), source, pa.array([part] * (hi - lo), pa.int64()), pa.array(before, pa.int64()),
                    pa.array(sizes, pa.int64()), pa.array([raw[e - width * (n - 1) : e] + end for e, n in zip(stop, sizes)], pa.binary()),
                ], names)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), "text")
    return rows.mapInArrow(encode, _IDS)


def _shared_queue(queues: DataFrame, slots: int = 1024) -> tuple[DataFrame, int]:
    """(source, part, first) in one queue of all ``queues`` (source, part, size), ordered by slot of the source's hash, and its length."""
    w = Window.partitionBy("slot").orderBy("source", "part")
    rows = queues.withColumn("slot", F.pmod(F.xxhash64("source"), F.lit(slots)).cast("int"))
    rows = written(rows.withColumn("within", F.sum("size").over(w) - F.col("size")), "packing-shared")
    starts, at = [], 0
    for r in rows.groupBy("slot").agg(F.sum("size").alias("size")).orderBy("slot").collect():
        starts.append((r["slot"], at))
        at += r["size"]
    offsets = queues.sparkSession.createDataFrame(starts, "slot int, start long")
    return rows.join(F.broadcast(offsets), "slot").select("source", "part", (F.col("start") + F.col("within")).alias("first")), at


def pack(
    docs: DataFrame, window: int = 2048, weights: dict[str | None, float] | None = None, vocabulary: str | None = None,
    end_id: int = 1, max_sources: int = 4096, with_ids: bool = False,
) -> DataFrame:
    """Pieces of all documents: see the module. ``with_ids`` adds each piece's ids (binary)."""
    vocabulary = vocabulary or default_vocabulary()
    id_type = _id_type(vocabulary, end_id)
    ids = written(tokenised(docs, vocabulary, end_id, id_type), "packing-ids")
    queues = ids.groupBy("source", "part").agg(F.sum("n").alias("size"))
    sizes = queues.groupBy("source").agg(F.sum("size").alias("size"))
    totals = {r["source"]: r["size"] for r in sizes.orderBy(F.desc("size"), "source").limit(max_sources + 1).collect()}
    rest = None
    if len(totals) > max_sources:
        totals = dict(list(totals.items())[: max_sources - 1])
        named = docs.sparkSession.createDataFrame([(s,) for s in totals], "_source string")
        rest = queues.join(F.broadcast(named), F.col("source").eqNullSafe(F.col("_source")), "left_anti")
        queues = queues.join(F.broadcast(named), F.col("source").eqNullSafe(F.col("_source")), "left_semi")
    order = sorted(totals, key=lambda s: (s is not None, s or ""))
    lengths = [totals[s] for s in order]
    places = queues.select("source", "part", (F.sum("size").over(Window.partitionBy("source").orderBy("part")) - F.col("size")).alias("first"))
    if rest is not None:
        shared, length = _shared_queue(rest)
        places, lengths = places.unionByName(shared), [*lengths, length]
    # written, so that Spark knows its size: it broadcasts the table only below its own threshold
    places = written(places, "packing-places")
    if weights is None:
        shares = lengths
    else:
        parts = [Fraction(weights.get(s, 0)).limit_denominator(10**6) for s in order]
        if rest is not None:  # every source has a weight, so no more than those can come
            others = [r["source"] for r in rest.select("source").distinct().limit(len(weights) + 1).collect()]
            each = [Fraction(weights.get(s, 0)).limit_denominator(10**6) for s in others]
            parts.append(sum(each) if all(x > 0 for x in each) else Fraction(0))
        if any(p <= 0 for p in parts):
            raise ValueError("every source needs a positive weight")
        base = math.lcm(*[p.denominator for p in parts])
        shares = [int(p * base) for p in parts]
    number = {s: i for i, s in enumerate(order)}
    args = (lengths, shares, window)
    schema = _PIECES + (", ids binary" if with_ids else "")
    types = pa.schema([(c.split()[0], pa.string() if c.split()[1] == "string" else pa.binary() if c.split()[1] == "binary" else pa.int64()) for c in schema.split(", ")])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rounds = Rounds(*args)
        for b in batches:
            cols: list[list] = [[] for _ in types]
            doc_ids, sources, firsts, sizes = (b.column(c).to_pylist() for c in ("doc_id", "source", "queue_start", "n"))
            for doc_id, source, first, n, raw in zip(doc_ids, sources, firsts, sizes, b.column("ids")):
                doc = np.frombuffer(raw.as_buffer(), id_type).astype("<u4")
                for start, length, at in rounds.cut(number.get(source, len(number)), first, n):
                    piece = doc[start : start + length]
                    row = (doc_id, source, start, length, zlib.crc32(piece), n, at // window, at % window)
                    for c, v in zip(cols, (*row, piece.tobytes()) if with_ids else row):
                        c.append(v)
                if len(cols[0]) >= 50_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(cols, types)], types.names)
                    cols = [[] for _ in types]
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(cols, types)], types.names)

    placed = ids.join(places.withColumnsRenamed({"source": "_source", "part": "_part"}),
                      F.col("source").eqNullSafe(F.col("_source")) & (F.col("part") == F.col("_part"))).select(
        "doc_id", "source", (F.col("first") + F.col("before")).alias("queue_start"), "n", "ids"
    )
    return placed.mapInArrow(cut, schema)
