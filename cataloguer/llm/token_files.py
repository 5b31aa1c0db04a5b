"""Token-ID / binary output: documents as Simple-8b coded id shards, and their reader.

Documents are dealt out by ranges of doc_id, sorted inside each range, encoded to
ids and written in that order. A shard is what one range task writes: rows of one
file format inside a Parquet container, so any file system that Spark writes works
and the commit of a retried task is safe. One row is one block::

    shard, block   position of the block: shards ascend by doc_id, blocks inside a shard
    doc_ids        doc_id of each document piece in the block
    lengths        number of ids of each piece
    last           whether the piece ends its document
    words          little-endian Simple-8b words, the selector in the lowest 4 bits
    offsets        for every ``GROUP`` ids, the index of the word that starts them:
                   a reader enters the block there and decodes only what it needs

Groups of ids are coded on their own (no word spans two groups). A document
longer than a block continues in the next block as a further piece.

Defined cases: null or empty text gives only the end id; repeated doc_ids stay
side by side, in the order of their texts; a null doc_id sorts first; an empty
table gives no blocks; other columns are not written.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import simple8b
from .bpe import default_vocabulary, word_encoder
from .registry import written

BLOCK = 1 << 17
GROUP = 1 << 14
_BLOCK_SCHEMA = "shard long, block long, doc_ids array<long>, lengths array<long>, last array<boolean>, words binary, offsets array<long>"


class _Blocks:
    """Collects document pieces into blocks of ``BLOCK`` ids."""

    def __init__(self, shard: int):
        self.shard, self.block = shard, 0
        self._clear()

    def _clear(self):
        self.ids, self.doc_ids, self.lengths, self.last, self.size = [], [], [], [], 0

    def add(self, doc_id, ids: np.ndarray):
        at = 0
        while True:
            take = min(len(ids) - at, BLOCK - self.size)
            end = at + take == len(ids)
            self.ids.append(ids[at : at + take])
            self.doc_ids.append(doc_id)
            self.lengths.append(take)
            self.last.append(end)
            self.size += take
            at += take
            if self.size >= BLOCK:
                yield self.row()
            if end:
                return

    def row(self) -> tuple:
        ids = np.concatenate(self.ids)
        words, offsets, n = [], [], 0
        for a in range(0, len(ids), GROUP):
            offsets.append(n)
            words.append(simple8b.encode(ids[a : a + GROUP]))
            n += len(words[-1])
        out = (self.shard, self.block, self.doc_ids, self.lengths, self.last, np.concatenate(words).astype("<u8").tobytes(), offsets)
        self.block += 1
        self._clear()
        return out


def write_shards(docs: DataFrame, name: str = "token-shards", vocabulary: str | None = None, end_id: int = 0) -> DataFrame:
    """Encode ``docs`` (doc_id, text) and write the shards; returns the written block table."""
    path = vocabulary or default_vocabulary()
    ordered = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
        .repartitionByRange("doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"), "text")
    )
    names = [f.split()[0] for f in _BLOCK_SCHEMA.split(", ")]
    types = pa.schema([
        ("shard", pa.int64()), ("block", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())),
        ("last", pa.list_(pa.bool_())), ("words", pa.binary()), ("offsets", pa.list_(pa.int64())),
    ])

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), types)], names)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder = word_encoder(path)
        blocks = _Blocks(TaskContext.get().partitionId())
        end = np.array([end_id], np.uint32)
        for b in batches:
            doc_ids = b.column(0).to_pylist()
            for lo, hi, ids, counts in encoder.encode(b.column(1)):
                stop = np.cumsum(counts)
                for i in range(hi - lo):
                    doc = np.concatenate([ids[stop[i] - counts[i] : stop[i]], end])
                    for row in blocks.add(doc_ids[lo + i], doc):
                        yield batch([row])
        if blocks.lengths:
            yield batch([blocks.row()])

    return written(ordered.mapInArrow(encode, _BLOCK_SCHEMA), name)


def read_ids(words: bytes, offsets: list[int], n: int, start: int = 0, stop: int | None = None) -> np.ndarray:
    """Ids ``[start, stop)`` of a block of ``n`` ids; only the groups that hold them are decoded."""
    stop = n if stop is None else min(stop, n)
    w = np.frombuffer(words, "<u8")
    ends = [*offsets[1:], len(w)]
    parts = [np.zeros(0, np.uint32)]
    for g in range(start // GROUP, -(-stop // GROUP)):
        size = min(GROUP, n - g * GROUP)
        ids = simple8b.decode(w[offsets[g] : ends[g]], size).astype(np.uint32)
        parts.append(ids[max(0, start - g * GROUP) : max(0, stop - g * GROUP)])
    return np.concatenate(parts)


def read_pieces(blocks: DataFrame) -> DataFrame:
    """Decode blocks into pieces: shard, block, piece, doc_id, last, ids (binary, little-endian uint32)."""
    schema = "shard long, block long, piece long, doc_id long, last boolean, ids binary"

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(b.num_rows):
                r = {name: b.column(name)[k].as_py() for name in b.schema.names}
                raw = read_ids(r["words"], r["offsets"], sum(r["lengths"])).astype("<u4").tobytes()
                stop = np.cumsum(r["lengths"])
                m = len(stop)
                yield pa.RecordBatch.from_arrays([
                    pa.array([r["shard"]] * m, pa.int64()), pa.array([r["block"]] * m, pa.int64()), pa.array(range(m), pa.int64()),
                    pa.array(r["doc_ids"], pa.int64()), pa.array(r["last"], pa.bool_()),
                    pa.array([raw[4 * (e - n) : 4 * e] for e, n in zip(stop.tolist(), r["lengths"])], pa.binary()),
                ], [c.split()[0] for c in schema.split(", ")])

    return blocks.mapInArrow(decode, schema)


def document_digests(blocks: DataFrame) -> DataFrame:
    """Per document, read from the shards: doc_id, start (ids before it over all shards), n_tokens, ids_crc32.

    A shard's tasks are streams over its blocks, so a document over many blocks
    needs only its running checksum. Block rows are small in number; the sum of
    ids per shard (one row per range partition) gives each shard's start.
    """
    per_doc = "shard long, doc_id long, before long, n_tokens long, ids_crc32 long"

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, before, crc, n = None, 0, 0, 0
        for b in batches:
            cols: list[list] = [[], [], [], [], []]
            for k in range(b.num_rows):
                r = {name: b.column(name)[k].as_py() for name in b.schema.names}
                if r["shard"] != shard:
                    shard, before, crc, n = r["shard"], 0, 0, 0
                raw = read_ids(r["words"], r["offsets"], sum(r["lengths"])).astype("<u4").tobytes()
                at = 0
                for doc_id, length, last in zip(r["doc_ids"], r["lengths"], r["last"]):
                    crc = zlib.crc32(raw[4 * at : 4 * (at + length)], crc)
                    at, n = at + length, n + length
                    if last:
                        for c, v in zip(cols, (shard, doc_id, before, n, crc)):
                            c.append(v)
                        before, crc, n = before + n, 0, 0
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], [c.split()[0] for c in per_doc.split(", ")])

    shards = blocks.groupBy("shard").agg(F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x)).alias("n"))
    starts = shards.select("shard", (F.sum("n").over(Window.orderBy("shard")) - F.col("n")).alias("shard_start"))
    docs = blocks.repartition("shard").sortWithinPartitions("shard", "block").mapInArrow(digest, per_doc)
    return docs.join(starts, "shard").select(
        "doc_id", (F.col("shard_start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32", "shard"
    )
