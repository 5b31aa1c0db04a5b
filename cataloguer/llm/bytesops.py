"""Numpy helpers over the UTF-8 bytes of an Arrow string batch (no per-row Python strings).

A batch is taken in chunks of whole texts, so memory follows the chunk size (or the
longest single text), not the batch. Spans are hashed with a polynomial hash over
prefix sums modulo 2^64 and a final mix: one pass over the bytes however many spans.
Such a hash has built-in collisions of long, regular strings, so spans of over
``LONG_SPAN`` bytes take a cryptographic digest, and ``WordIndex`` compares the bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20
LONG_SPAN = 64
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_BASE_INV = np.uint64(pow(int(_BASE), -1, 1 << 64))
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def text_chunks(column: pa.Array, max_bytes: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Yield (first row, end row, bytes, offsets) over a string column; a null text is empty.

    ``offsets`` has one entry more than rows and starts at 0. A chunk holds at
    least one text, and more while they fit ``max_bytes``.
    """
    if column.null_count:
        column = column.fill_null("")
    if pa.types.is_large_string(column.type) or not pa.types.is_string(column.type):
        column = column.cast(pa.large_string())
        width = np.int64
    else:
        width = np.int32
    n = len(column)
    if not n:
        return
    buffers = column.buffers()
    off = np.frombuffer(buffers[1], width)[column.offset : column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        end = int(np.searchsorted(off, off[at] + max_bytes, "right")) - 1
        end = min(max(end, at + 1), n)
        yield at, end, data[off[at] : off[end]], off[at : end + 1] - off[at]
        at = end


def _power_table(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, CHUNK_BYTES + 1)
        for k, base in enumerate((_BASE, _BASE_INV)):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            _powers[k] = np.cumprod(p)
    return _powers[0][:n], _powers[1][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (bijective): spreads every input bit over the word."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Prefix sums (length n + 1) from which ``span_hash`` takes any span's hash."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _power_table(len(data) + 1)[0][: len(data)], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray, data: np.ndarray | None = None) -> np.ndarray:
    """64-bit hashes of the byte spans [start, end); equal spans have equal hashes anywhere. With ``data``, long spans take digests."""
    inv = _power_table(len(prefix))[1]
    h = (prefix[ends] - prefix[starts]) * inv[starts]
    h = mix(h + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    for k in np.flatnonzero(ends - starts > LONG_SPAN).tolist() if data is not None else ():
        h[k] = int.from_bytes(hashlib.blake2b(data[starts[k] : ends[k]], digest_size=8).digest(), "little")
    return h


class HashIndex:
    """Open-addressing map from 64-bit hashes to consecutive numbers, vectorised."""

    def __init__(self, bits: int = 12):
        self._reset(bits)

    def _reset(self, bits: int) -> None:
        self.bits, self.size = bits, 0
        self._keys = np.zeros(1 << bits, np.uint64)
        self._vals = np.full(1 << bits, -1, np.int32)

    def lookup(self, h: np.ndarray) -> np.ndarray:
        """Number of each hash, -1 where it is unknown."""
        mask = (1 << self.bits) - 1
        slot = (h >> np.uint64(64 - self.bits)).astype(np.int64)
        out = self._vals[slot]
        todo = np.flatnonzero((out >= 0) & (self._keys[slot] != h))
        slot = slot[todo]
        while len(todo):
            slot = (slot + 1) & mask
            v = self._vals[slot]
            out[todo] = v
            more = (v >= 0) & (self._keys[slot] != h[todo])
            todo, slot = todo[more], slot[more]
        return out

    def add(self, h: np.ndarray) -> None:
        """Number new, distinct hashes in their given order."""
        need = self.size + len(h)
        if need * 2 > (1 << self.bits):
            keys, vals = self._keys[self._vals >= 0], self._vals[self._vals >= 0]
            size = self.size
            self._reset(max(self.bits + 1, int(need * 2).bit_length()))
            self._place(keys, vals)
            self.size = size
        self._place(h, np.arange(self.size, need, dtype=np.int32))
        self.size = need

    def _place(self, h: np.ndarray, vals: np.ndarray) -> None:
        mask = (1 << self.bits) - 1
        slot = (h >> np.uint64(64 - self.bits)).astype(np.int64)
        while len(h):
            free = self._vals[slot] < 0
            self._vals[slot[free]] = vals[free]  # of several for one slot, the last stays
            won = free & (self._vals[slot] == vals)
            self._keys[slot[won]] = h[won]
            h, vals, slot = h[~won], vals[~won], (slot[~won] + 1) & mask


def flat_ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenated aranges [start, start + length) of all spans."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    first = np.cumsum(lengths) - lengths
    return np.arange(total, dtype=np.int64) + np.repeat(starts - first, lengths)


class WordIndex:
    """Consecutive numbers of distinct byte strings: found by hash, and known only if the bytes are equal."""

    def __init__(self, bits: int = 16):
        self._index = HashIndex(bits)
        self._raw = np.zeros(1 << 16, np.uint8)
        self._at = np.zeros(1, np.int64)  # start of each string in ``_raw``, and the end

    def __len__(self) -> int:
        return self._index.size

    def lookup(self, h: np.ndarray, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Numbers of the strings that ``data`` is cut into at ``starts`` (the first is 0): -1 unknown, -2 another string has its hash."""
        known = self._index.lookup(h)
        sizes = np.diff(np.append(starts, len(data)))
        there = np.maximum(known, 0)
        same = (known >= 0) & (self._at[np.minimum(there + 1, len(self._at) - 1)] - self._at[there] == sizes)
        place = np.repeat(np.where(same, self._at[there], 0) - starts * same, sizes) + np.arange(len(data)) * np.repeat(same, sizes)
        unlike = np.add.reduceat((self._raw[place] != data).astype(np.int64), starts) > 0
        known[(known >= 0) & (~same | unlike)] = -2
        return known

    def add(self, h: np.ndarray, words: list[bytes]) -> None:
        """Number new strings of new, distinct hashes in their given order."""
        raw = np.frombuffer(b"".join(words), np.uint8)
        end = int(self._at[-1])
        while end + len(raw) > len(self._raw):
            self._raw = np.concatenate([self._raw, np.zeros(len(self._raw), np.uint8)])
        self._raw[end : end + len(raw)] = raw
        self._at = np.concatenate([self._at, end + np.cumsum([len(w) for w in words], dtype=np.int64)])
        self._index.add(h)
