r"""Exact dedup of documents by recipes of content-defined chunks.

Texts are equal when identical after replacing each ``[\x20\x09-\x0D]+`` by one blank.
A text is cut where a rolling (gear) hash of its last 32 bytes has some zero bits, so
cuts follow the content and equal passages give equal chunks wherever they stand. The
text becomes a recipe, the ordered list of its chunks' identifiers, and only recipes
are compared, joined and moved again; a document's text never is.

Identifiers are digests that have been verified: each task sends a chunk once, chunks
meet by digest, and their bytes are compared. If two different chunks ever share a
digest, all recipes are made again with twice the width and another salt, so a result
is only built on identifiers that stand for one chunk each.

Equal recipes form a group. A group may hold a third of all rows: its size and first
row are worked out per (recipe, salt) first, and go back to the rows by (recipe, salt).

Defined cases: a null text counts as empty, and all empty texts are equal; a text of
white space only is one blank, which is not empty; of equal texts the row with the
smallest doc_id stays, a null doc_id is later than any, and of rows that share that
doc_id too exactly one stays; extra columns are not looked at; an empty table stays
empty.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bytesops import mix, text_chunks
from .registry import written

_BLANK = b" \t\n\x0b\x0c\r"
_RECIPES = "doc_id long, recipe binary, n_chunks long, n_bytes long, text_sha256 string"
_CHUNKS = "digest binary, chunk binary"


@dataclass(frozen=True)
class RecipeParams:
    """Production parameters. ``memo_bytes`` bounds the chunks a task remembers as sent."""

    min_chunk: int = 512
    max_chunk: int = 16_384
    cut_bits: int = 11
    digest_bytes: int = 16
    salts: int = 32
    memo_bytes: int = 32 << 20


def normalised(raw: bytes) -> bytes:
    """UTF-8 text with each run of white space as one blank."""
    out = b" ".join(raw.split())
    if out and raw[0] in _BLANK:
        out = b" " + out
    return out + b" " if raw and raw[-1] in _BLANK else out


def gear_hashes(data: np.ndarray) -> np.ndarray:
    """For each byte a hash of the 32 bytes that end there: sum of gear[byte] << distance, by doubling."""
    h = mix(np.arange(1, 257, dtype=np.uint64)).astype(np.uint32)[data]
    for width in (1, 2, 4, 8, 16):
        h[width:] += h[:-width] << np.uint32(width)
    return h


def cuts(places: list[int], size: int, p: RecipeParams) -> list[int]:
    """Ends of the chunks of a text of ``size`` bytes, given the places its content proposes."""
    out, start = [], 0
    for place in [*places, size]:
        while place - start > p.max_chunk:
            start += p.max_chunk
            out.append(start)
        if place < size and place - start >= p.min_chunk:
            start = place
            out.append(start)
    if start < size:
        out.append(size)
    return out


def cut_texts(column: pa.Array, p: RecipeParams) -> Iterator[tuple[bytes, list[int]]]:
    """(normalised text, ends of its chunks) of every text of a column."""
    mask = np.uint32(((1 << p.cut_bits) - 1) << (32 - p.cut_bits))
    for _, _, data, offsets in text_chunks(column):
        raw = data.tobytes()
        texts = [normalised(raw[a:b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
        ends = np.cumsum([len(t) for t in texts])
        # the first bytes of a text mix with the text before; no chunk is that short
        places = np.flatnonzero((gear_hashes(np.frombuffer(b"".join(texts), np.uint8)) & mask) == 0) + 1
        at = np.searchsorted(places, ends, "right")
        first = 0
        for text, end, last in zip(texts, ends.tolist(), at.tolist()):
            begin = end - len(text)
            yield text, cuts((places[first:last] - begin).tolist(), len(text), p)
            first = last


def _digest(chunk: bytes, width: int) -> bytes:
    return hashlib.blake2b(chunk, digest_size=width, salt=width.to_bytes(2, "little")).digest()


def _pieces(text: bytes, ends: list[int]) -> list[bytes]:
    return [text[a:b] for a, b in zip([0, *ends], ends)]


def recipes(docs: DataFrame, width: int, p: RecipeParams = RecipeParams()) -> DataFrame:
    """Recipe of every row of ``docs`` (doc_id, text): digests of ``width`` bytes, back to back."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols: list[list] = [[], [], [], []]
            for text, ends in cut_texts(b.column(1), p):
                row = (b"".join(_digest(c, width) for c in _pieces(text, ends)), len(ends), len(text), hashlib.sha256(text).hexdigest())
                for col, v in zip(cols, row):
                    col.append(v)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *[pa.array(c, t) for c, t in zip(cols, (pa.binary(), pa.int64(), pa.int64(), pa.string()))]],
                ["doc_id", "recipe", "n_chunks", "n_bytes", "text_sha256"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(make, _RECIPES)


def chunks(docs: DataFrame, width: int, p: RecipeParams = RecipeParams()) -> DataFrame:
    """(digest, chunk) of all texts; a task leaves out what it remembers to have sent."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: dict[bytes, bytes] = {}
        held = 0
        for b in batches:
            out: list[tuple[bytes, bytes]] = []
            size = 0
            for text, ends in cut_texts(b.column(0), p):
                for c in _pieces(text, ends):
                    d = _digest(c, width)
                    if sent.get(d) == c:
                        continue
                    if held > p.memo_bytes:
                        sent, held = {}, 0
                    sent[d] = c
                    held += len(c) + 200
                    out.append((d, c))
                    size += len(c)
                if size > 8 << 20:
                    yield _batch(out)
                    out, size = [], 0
            yield _batch(out)

    def _batch(rows: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.binary()) for k in (0, 1)], ["digest", "chunk"])

    return docs.select("text").mapInArrow(make, _CHUNKS)


def collisions(sent: DataFrame) -> DataFrame:
    """Digests that stand for two different chunks. Chunks travel once; their bytes are compared where they meet."""
    met = sent.repartition("digest").groupBy("digest").agg(F.min("chunk").alias("low"), F.max("chunk").alias("high"))
    return met.where("low <> high").select("digest")


def verified_recipes(docs: DataFrame, p: RecipeParams = RecipeParams()) -> DataFrame:
    """Recipes whose identifiers stand for one chunk each, with a number for every row (``row``), written."""
    width = p.digest_bytes
    while collisions(chunks(docs, width, p)).limit(1).count():
        if width == hashlib.blake2b.MAX_DIGEST_SIZE:
            raise ValueError("two chunks share their widest digest")
        width = min(2 * width, hashlib.blake2b.MAX_DIGEST_SIZE)
    return written(recipes(docs, width, p).withColumn("row", F.monotonically_increasing_id()), "exact-recipes")


def exact_dedup(docs: DataFrame, params: RecipeParams = RecipeParams()) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256, n_chunks, n_bytes) of every row of ``docs``."""
    rows = verified_recipes(docs, params).withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(params.salts)))
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")
    parts = rows.groupBy("recipe", "salt").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("n"))
    groups = parts.groupBy("recipe").agg(F.min("first").alias("keep"), F.sum("n").alias("group_size"))
    back = parts.select(F.col("recipe").alias("_recipe"), F.col("salt").alias("_salt")).join(
        groups, F.col("_recipe") == F.col("recipe")).drop("recipe")
    return rows.join(back, (F.col("recipe") == F.col("_recipe")) & (F.col("salt") == F.col("_salt"))).select(
        "doc_id", F.col("keep.doc_id").alias("keep_id"), "group_size", (F.col("row") == F.col("keep.row")).alias("kept"),
        "text_sha256", "n_chunks", "n_bytes",
    )


def first_copies(docs: DataFrame, params: RecipeParams = RecipeParams()) -> DataFrame:
    """The rows of ``docs`` whose text no row with a smaller doc_id has; rows of equal doc_id and text stay together."""
    kept = exact_dedup(docs, params).where("kept").select(F.col("doc_id").alias("_doc_id"), F.col("text_sha256").alias("_sha")).distinct()
    blank = F.regexp_replace(F.coalesce(docs["text"], F.lit("")), r"[\x20\x09-\x0D]+", " ")
    return docs.join(kept, docs["doc_id"].eqNullSafe(F.col("_doc_id")) & (F.sha2(blank, 256) == F.col("_sha")), "left_semi")
