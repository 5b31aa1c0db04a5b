"""Benchmark decontamination: CGK embedding, bit-sampling LSH over windows, exact edit verification.

Texts and items are folded first (lower case, every run of other characters than
letters and digits one blank), so case, punctuation and line ends do not matter.

The CGK embedding walks over a string with a shared random function: step j writes
the character under the pointer and moves on by a random bit that depends on j and
that character. Strings a few edits apart fall back into step after each edit, so
edit distance becomes Hamming distance, and sampled coordinates of two embeddings
agree with a probability that falls with the edits. A key is a sample of
coordinates; a repetition is an independent sample. The windows are those that
start at a word of a document and reach over an item; an item is entered at
``entries`` of its words, so edits near one entry leave the others. The number of
repetitions follows from ``recall``: it is the smallest that finds this part of copies
of the items that are edited at the rate ``max_error`` and that verification accepts.
If ``max_repetitions`` find fewer, a warning is logged.

All windows of a chunk of texts walk together, as numpy arrays. The first
coordinates of a key lie early in the walk; only windows whose early coordinates
occur in some item's key walk on. Where a whole key agrees, the Hamming distance of
all coordinates written so far estimates the edit distance; pairs under
``max_hamming`` (unrelated strings differ in nearly all coordinates) are verified
exactly: the smallest edit distance of the item to any substring around the window
(Myers' bit vectors) must be at most ``max_error`` of its length.

Sampled keys leave some copies out, so an exact pass follows (``ItemPieces``): every
place of a text where a piece of an item stands unchanged, with the piece beside it
within one edit, is verified too. No pair within the accepted error is without such
a place, so the result is whole, and distances are the smallest of the text.

The benchmark is a stated query set: it is taken in blocks of ``block_items``, which
bounds what a task holds, and each block meets all documents in one pass without
any shuffle.

Defined cases: null or empty texts and items match nothing; items under ``min_chars``
folded characters are left out (too short to tell a leak from chance); repeated
document rows give a row each; repeated items each give rows; an empty table gives
no rows; extra columns are not read.
"""

from __future__ import annotations

import logging
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bytesops import HashIndex, mix

_SCHEMA = "doc_id long, item_id long, distance long"
SLOT_BITS = 22
_OTHER = re.compile(r"[\W_]+")
#: Scripts without blanks below U+3000: Thai and Lao, Myanmar, Khmer, Tai Le and New Tai Lue, Buginese and Tai Tham.
_NO_BLANKS = ((0xE00, 0xEFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x1950, 0x19FF), (0x1A00, 0x1AAF))
_LOG = logging.getLogger(__name__)


@dataclass(frozen=True)
class LeakParams:
    """Production parameters."""

    max_error: float = 0.1
    recall: float = 0.97
    min_chars: int = 40
    entries: int = 12
    early: tuple[int, int] = (6, 32)  # coordinates, of the first steps
    late: int = 5
    tiers: tuple[tuple[int, int], ...] = ((90, 160), (40, 72))  # (characters left from the entry, last step)
    max_hamming: float = 0.6
    max_repetitions: int = 24
    block_items: int = 20_000
    seed: int = 7


def fold(text: str | None) -> str:
    """Lower case, words of letters and digits, single blanks."""
    return _OTHER.sub(" ", (text or "").lower()).strip()


class Embedding:
    """The shared walk and the sampled coordinates of every repetition."""

    def __init__(self, p: LeakParams, repetitions: int):
        rng = np.random.default_rng(p.seed)
        self.steps = max(last for _, last in p.tiers)
        self.move = rng.integers(0, 2, (self.steps, 256), dtype=np.int64)
        self.early_end = p.early[1]
        self.early, self.late = [], []
        for _ in range(repetitions):
            self.early.append(np.sort(rng.choice(p.early[1], p.early[0], replace=False)))
            self.late.append([np.sort(p.early[1] + rng.choice(last - p.early[1], p.late, replace=False)) for _, last in p.tiers])

    def walk(self, data: np.ndarray, at: np.ndarray, begin: int, end: int) -> tuple[np.ndarray, list[np.ndarray]]:
        """Steps [begin, end) from the pointers ``at``: pointers after, and the character of each step."""
        written = []
        for j in range(begin, end):
            c = data[at]
            written.append(c)
            at = at + self.move[j][c]
        return at, written

    @staticmethod
    def slot(r: int, chars: list[np.ndarray]) -> np.ndarray:
        """Slot of an early sample in a table of ``1 << SLOT_BITS`` flags."""
        word = np.full(len(chars[0]), r, np.uint32)
        for c in chars:
            word *= np.uint32(0x01000193)
            word ^= c
        word *= np.uint32(0x9E3779B1)
        word >>= np.uint32(32 - SLOT_BITS)
        return word

    @staticmethod
    def key(tag: int, chars: list[np.ndarray]) -> np.ndarray:
        """Hash of a sample of coordinates."""
        word = np.full(len(chars[0]), tag, np.uint64)
        for c in chars:
            word = word * np.uint64(257) + c.astype(np.uint64)
        return mix(word)


class ItemIndex:
    """Keys of a block of items."""

    def __init__(self, items: list[tuple[int, str]], p: LeakParams, repetitions: int):
        self.p, self.items, self.embedding = p, items, Embedding(p, repetitions)
        self.entries: list[tuple[int, int]] = []  # (item number, offset of the entry)
        whole: dict[int, list[int]] = {}
        parts, starts, tiers = [], [], []
        size = 0
        for number, (_, text) in enumerate(items):
            raw = text.encode()
            parts += [raw, b" " * (self.embedding.steps + 1)]
            words = word_starts(np.frombuffer(raw, np.uint8)).tolist()
            for e in sorted({words[len(words) * k // p.entries] for k in range(p.entries)}):
                tier = next((t for t, (least, _) in enumerate(p.tiers) if len(raw) - e >= least), None)
                if tier is not None:
                    self.entries.append((number, e))
                    starts.append(size + e)
                    tiers.append(tier)
            size += len(raw) + self.embedding.steps + 1
        self.seen, self.whole = np.zeros(1 << SLOT_BITS, bool), whole
        if not starts:
            return
        data = np.frombuffer(b"".join(parts), np.uint8)
        at, tiers = np.array(starts), np.array(tiers)
        _, chars = self.embedding.walk(data, at, 0, self.embedding.steps)
        self.written, self.reach = np.stack(chars, axis=1), np.array([last for _, last in p.tiers])[tiers]
        for r, coordinates in enumerate(self.embedding.early):
            self.seen[self.embedding.slot(r, [chars[j] for j in coordinates])] = True
            first = self.embedding.key(2 * r, [chars[j] for j in coordinates])
            for t, late in enumerate(self.embedding.late[r]):
                key = self.embedding.key(2 * r + 1, [first, *(chars[j] for j in late)])
                for i in np.flatnonzero(tiers == t).tolist():
                    whole.setdefault(int(mix(key[i : i + 1] + np.uint64(t))[0]), []).append(i)
        self.late_index = HashIndex(12)
        self.late_keys = np.array(sorted(whole), np.uint64)
        self.late_index.add(self.late_keys)

    def candidates(self, data: np.ndarray, starts: np.ndarray) -> Iterator[tuple[int, int]]:
        """(window start, entry number) pairs whose keys agree."""
        if not self.entries or not len(starts):
            return
        e = self.embedding
        after, chars = e.walk(data, starts, 0, e.early_end)
        known = [self.seen[e.slot(r, [chars[j] for j in c])] for r, c in enumerate(e.early)]
        alive = np.flatnonzero(np.logical_or.reduce(known))
        if not len(alive):
            return
        _, later = e.walk(data, after[alive], e.early_end, e.steps)
        rows, entries = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for r, coordinates in enumerate(e.early):
            on = np.flatnonzero(known[r][alive])
            first = e.key(2 * r, [chars[j][alive[on]] for j in coordinates])
            for t, late in enumerate(e.late[r]):
                key = e.key(2 * r + 1, [first, *(later[j - e.early_end][on] for j in late)])
                number = self.late_index.lookup(mix(key + np.uint64(t)))
                hit = np.flatnonzero(number >= 0)
                lists = [self.whole[k] for k in self.late_keys[number[hit]].tolist()]
                rows.append(np.repeat(on[hit], [len(x) for x in lists]))
                entries.append(np.array([x for y in lists for x in y], np.int64))
        pairs = np.unique(np.concatenate(rows) * len(self.entries) + np.concatenate(entries))
        row, entry = np.divmod(pairs, len(self.entries))
        differ = np.zeros(len(pairs), np.int64)
        for j in range(e.steps):
            c = chars[j][alive[row]] if j < e.early_end else later[j - e.early_end][row]
            differ += (c != self.written[entry, j]) & (j < self.reach[entry])
        near = np.flatnonzero(differ <= self.p.max_hamming * self.reach[entry])
        yield from zip(starts[alive[row[near]]].tolist(), entry[near].tolist())


class ItemPieces:
    """Pieces of a block of items, taken two by two: an exact filter for texts within the accepted edits.

    An item with k edits allowed is cut in k + 1 pieces, or k + 2 to make them even. If
    every couple of neighbours had two edits, there would be more than k; so in a text within k edits
    some couple has at most one: one of its pieces stands there unchanged, the other right beside it within
    one edit. Places are found by hashes of the first characters of a piece and then compared.
    """

    KEY, SHIFT, BLOCK = 8, np.uint64(64 - SLOT_BITS), 1 << 16

    def __init__(self, items: list[tuple[int, str]], p: LeakParams):
        number, begin, end, near, outward, near_size = [], [], [], [], [], []
        starts, keys, size = [], [], 0
        for i, (_, text) in enumerate(items):
            pieces = int(p.max_error * len(text)) + 1
            pieces += pieces % 2
            cuts = [len(text) * k // pieces for k in range(pieces + 1)]
            for k in range(pieces):
                right = k % 2 == 0
                number.append(i)
                begin.append(cuts[k])
                end.append(cuts[k + 1])
                near.append(size + (cuts[k + 1] if right else cuts[k] - 1))
                outward.append(1 if right else -1)
                near_size.append(cuts[k + 2] - cuts[k + 1] if right else cuts[k] - cuts[k - 1])
                starts.append(size + cuts[k])
                keys.append(max(1, min(self.KEY, len(text) // pieces)))
            size += len(text)
        self.number, self.offset = np.array(number, np.int64), np.array(begin, np.int64)
        self.size, self.near_size = np.array(end, np.int64) - self.offset, np.array(near_size, np.int64)
        self.outward, starts, keys = np.array(outward, np.int64), np.array(starts, np.int64), np.array(keys, np.int64)
        self.width = int(self.size.max()) if len(self.size) else 0
        codes = self._padded("".join(text for _, text in items))
        at = np.arange(self.width)
        self.own = codes[self.width + 1 + starts[:, None] + at]
        self.near = codes[self.width + 1 + np.array(near, np.int64)[:, None] + self.outward[:, None] * at]
        self.groups = []
        for q in np.unique(keys).tolist():
            which = np.flatnonzero(keys == q)
            whole = self._hashes(codes.astype(np.uint64), q)[self.width + 1 + starts[which]]
            order = np.argsort(whole, kind="stable")
            distinct, first, count = np.unique(whole[order], return_index=True, return_counts=True)
            seen = np.zeros(1 << SLOT_BITS, bool)
            seen[self._slot(distinct)] = True
            self.groups.append((q, seen, distinct, first, count, which[order]))

    def _padded(self, text: str) -> np.ndarray:
        """Code points of a text between zeros, so that reading over its ends meets nothing."""
        pad = np.zeros(self.width + 1, np.uint32)
        return np.concatenate([pad, np.frombuffer(text.encode("utf-32-le"), np.uint32), pad, np.zeros(self.KEY + 1, np.uint32)])

    @classmethod
    def _slot(cls, hashes: np.ndarray) -> np.ndarray:
        return (hashes * np.uint64(0x9E3779B97F4A7C15)) >> cls.SHIFT

    @classmethod
    def _hashes(cls, codes: np.ndarray, q: int) -> np.ndarray:
        """Hash of the ``q`` characters from each place on."""
        if q == 1:
            return codes
        left, right = cls._hashes(codes, q // 2), cls._hashes(codes, q - q // 2)
        n = len(codes) - q + 1
        return left[:n] * np.uint64(0xD6E8FEB86659FD93 + 2 * q) + right[q // 2 : q // 2 + n]

    def places(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """(place in ``text``, piece) of all pieces that stand in it beside their neighbours."""
        places, found = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        codes, front = self._padded(text), self.width + 1
        wide = codes.astype(np.uint64)
        for q, seen, distinct, first, count, pieces in self.groups:
            hashes = self._hashes(wide, q)[front : front + len(text)]
            at = np.flatnonzero(seen[self._slot(hashes)])
            key = np.minimum(np.searchsorted(distinct, hashes[at]), len(distinct) - 1)
            same = distinct[key] == hashes[at]
            at, key = at[same], key[same]
            upto = np.cumsum(count[key])
            lo = 0
            while lo < len(at):  # blocks of about BLOCK (place, piece) pairs
                hi = max(lo + 1, int(np.searchsorted(upto, (upto[lo - 1] if lo else 0) + self.BLOCK, "right")))
                n = count[key[lo:hi]]
                place = np.repeat(at[lo:hi], n) + front
                piece = pieces[np.repeat(first[key[lo:hi]] - np.cumsum(n) + n, n) + np.arange(len(place))]
                on = self._stands(codes, place, piece)
                places.append(place[on] - front)
                found.append(piece[on])
                lo = hi
        return np.concatenate(places), np.concatenate(found)

    def _stands(self, codes: np.ndarray, place: np.ndarray, piece: np.ndarray) -> np.ndarray:
        """Which pieces stand whole at their places, with their neighbours within one edit beside them."""
        at = np.arange(self.width)
        whole = ((codes[place[:, None] + at] == self.own[piece]) | (at >= self.size[piece][:, None])).all(axis=1)
        on = np.flatnonzero(whole)
        place, piece = place[on], piece[on]
        out, size, want = self.outward[piece], self.near_size[piece][:, None], self.near[piece]
        base = np.where(out > 0, place + self.size[piece], place - 1)
        text = codes[base[:, None] + out[:, None] * np.arange(self.width + 1)]
        done = at >= size
        equal = (text[:, :-1] == want) | done
        same = np.cumprod(equal, axis=1).sum(axis=1)[:, None]  # characters before the first edit
        changed = (equal | (at <= same)).all(axis=1)
        added = ((text[:, 1:] == want) | done | (at < same)).all(axis=1)
        missing = np.ones(len(on), bool)
        if self.width > 1:
            missing = ((text[:, : self.width - 1] == want[:, 1:]) | done[:, 1:] | (at[1:] <= same)).all(axis=1)
        return on[changed | added | missing]


def substring_distance(item: str, text: str, most: int) -> int | None:
    """Smallest edit distance of ``item`` to a substring of ``text``, None over ``most`` (Myers' bit vectors)."""
    m = len(item)
    where: dict[str, int] = {}
    for i, c in enumerate(item):
        where[c] = where.get(c, 0) | 1 << i
    mask, top = (1 << m) - 1, 1 << (m - 1)
    vp, vn, score = mask, 0, m
    best = m
    for c in text:
        eq = where.get(c, 0)
        x = eq | vn
        d = ((((eq & vp) + vp) ^ vp) | x) & mask
        hp = (vn | ~(d | vp)) & mask
        hn = d & vp
        if hp & top:
            score += 1
        elif hn & top:
            score -= 1
        hp, hn = (hp << 1) & mask, (hn << 1) & mask
        vp, vn = (hn | ~(d | hp)) & mask, d & hp
        if score < best:
            best = score
    return best if best <= most else None


def word_starts(data: np.ndarray) -> np.ndarray:
    """Places where a window may start: after blanks and text ends, and at each character of scripts without blanks."""
    blank = (data == 32) | (data == 0)
    start = ~blank & (data >= 0xE3)
    start[0] |= not blank[0]
    start[1:] |= blank[:-1] & ~blank[1:]
    lead = np.flatnonzero((data[:-2] & 0xFE) == 0xE0)  # of U+0800 to U+1FFF
    if len(lead):
        code = (data[lead] & np.int64(15)) << 12 | (data[lead + 1] & np.int64(63)) << 6 | (data[lead + 2] & np.int64(63))
        start[lead] |= np.logical_or.reduce([(code >= a) & (code <= b) for a, b in _NO_BLANKS])
    return np.flatnonzero(start)


def edited(text: str, rate: float, rng: np.random.Generator) -> str:
    """A copy with random substitutions, deletions and insertions."""
    out = []
    letters = "etaoinshr"
    for c in text:
        x = rng.random()
        if x < rate / 3:
            continue
        out.append(letters[rng.integers(9)] if x < 2 * rate / 3 else c)
        if 2 * rate / 3 <= x < rate:
            out.append(letters[rng.integers(9)])
    return "".join(out)


def accepted_copies(items: list[tuple[int, str]], p: LeakParams, rng: np.random.Generator) -> list[tuple[int, str]]:
    """(place of the item, copy edited at the rate ``max_error``) that verification accepts: one an item, of 20 drawn at most."""
    copies = []
    for number, (_, text) in enumerate(items):
        drawn = (edited(text, p.max_error, rng) for _ in range(20))
        copies += [(number, c) for c in drawn if substring_distance(text, c, int(p.max_error * len(text))) is not None][:1]
    return copies


def recall_of(items: list[tuple[int, str]], copies: list[tuple[int, str]], p: LeakParams, repetitions: int) -> float:
    """Part of the copies whose item is among their candidates."""
    index, found = ItemIndex(items, p, repetitions), 0
    for number, copy in copies:
        data = np.frombuffer(copy.encode() + b" " * (index.embedding.steps + 1), np.uint8)
        found += any(index.entries[e][0] == number for _, e in index.candidates(data, word_starts(data)))
    return found / len(copies) if copies else 1.0


def repetitions_for(items: list[tuple[int, str]], p: LeakParams) -> int:
    """Repetitions that reach ``recall`` on copies up to the accepted error, measured on up to 200 items."""
    sample = items[:: max(1, len(items) // 200)][:200]
    copies = accepted_copies(sample, p, np.random.default_rng(p.seed + 1))
    reached = 0.0
    for n in [n for n in (2, 4, 6, 8, 12, 16) if n < p.max_repetitions] + [p.max_repetitions]:
        reached = recall_of(sample, copies, p, n)
        if reached >= p.recall:
            return n
    _LOG.warning("decontamination finds %.3f of copies edited at %.3f in %d repetitions, not %.3f", reached, p.max_error, p.max_repetitions, p.recall)
    return p.max_repetitions


def _exact_leaks(texts: list[str], pieces: ItemPieces, items: list[tuple[int, str]], p: LeakParams, found: set[tuple[int, int]]) -> Iterator[tuple[int, int, int]]:
    """(number of the text, item number, distance) around all places of pieces, but for ``found`` pairs; windows that overlap are one."""
    starts = np.cumsum([0, *(len(t) + 1 for t in texts)])
    whole = "\x00".join(texts)
    place, piece = pieces.places(whole)
    if not len(place):
        return
    number, begin, text = pieces.number[piece], place - pieces.offset[piece], np.searchsorted(starts, place, "right") - 1
    most = np.array([int(p.max_error * len(t)) for _, t in items], np.int64)[number]
    size = np.array([len(t) for _, t in items], np.int64)[number]
    lo, hi = begin - most, begin + size + most
    order = np.lexsort((lo, number, text))
    window: tuple[int, int, int, int] | None = None
    for k, n, a, b in [*zip(text[order].tolist(), number[order].tolist(), lo[order].tolist(), hi[order].tolist()), (-1, -1, 0, 0)]:
        if window and window[:2] == (k, n) and a <= window[3]:
            window = (k, n, window[2], max(b, window[3]))
            continue
        if window and window[:2] not in found:
            w, item = window[0], items[window[1]][1]
            part = whole[max(window[2], int(starts[w])) : min(window[3], int(starts[w + 1]) - 1)]
            d = substring_distance(item, part, int(p.max_error * len(item)))
            if d is not None:
                yield w, window[1], d
        window = (k, n, a, b)


def _block_leaks(docs: DataFrame, items: list[tuple[int, str]], p: LeakParams) -> DataFrame:
    repetitions = repetitions_for(items, p) if items else 0
    shared = docs.sparkSession.sparkContext.broadcast(items)  # at most block_items items

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, exact = ItemIndex(shared.value, p, repetitions), ItemPieces(shared.value, p)
        steps = index.embedding.steps
        gap = b"\x00" * (steps + 1)
        for b in batches:
            out: list[list] = [[], [], []]
            at = 0
            texts = b.column(1)
            while at < len(texts):
                pieces, rows, places, folded, size = [], [], [], [], 0
                while at < len(texts) and size < 1 << 19:
                    text = fold(texts[at].as_py())
                    raw = text.encode()
                    if raw:
                        folded.append(text)
                        rows.append(at)
                        places.append(size)
                        pieces += [raw, gap]
                        size += len(raw) + len(gap)
                    at += 1
                if not rows:
                    continue
                raw = b"".join(pieces)
                data = np.frombuffer(raw, np.uint8)
                met: dict[tuple[int, int], int | None] = {}
                for start, entry in sorted(set(index.candidates(data, word_starts(data)))):
                    number, offset = index.entries[entry]
                    item_id, item = index.items[number]
                    most = int(p.max_error * len(item))
                    k = int(np.searchsorted(places, start, "right")) - 1
                    end = places[k + 1] - len(gap) if k + 1 < len(places) else size - len(gap)
                    slack = (2 * most + 4) * (1 if item.isascii() else 3)  # bytes
                    lo, hi = max(places[k], start - offset - slack), min(end, start - offset + len(item.encode()) + slack)
                    spot = (rows[k], number)
                    if met.get(spot) == 0:
                        continue
                    d = substring_distance(item, raw[lo:hi].decode("utf-8", "ignore"), most)
                    if d is not None and (met.get(spot) is None or d < met[spot]):
                        met[spot] = d
                place_of = {row: k for k, row in enumerate(rows)}
                found = {(place_of[row], number) for (row, number), d in met.items() if d == 0}
                for k, number, d in _exact_leaks(folded, exact, index.items, p, found):
                    spot = (rows[k], number)
                    if met.get(spot) is None or d < met[spot]:
                        met[spot] = d
                for (row, number), d in sorted(met.items()):
                    for col, v in zip(out, (b.column(0)[row].as_py(), index.items[number][0], d)):
                        col.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], ["doc_id", "item_id", "distance"])

    return docs.mapInArrow(search, _SCHEMA)


def find_leaks(docs: DataFrame, benchmark: DataFrame, params: LeakParams = LeakParams()) -> DataFrame:
    """(doc_id, item_id, distance): every document that holds an item of the benchmark, up to edits."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    items = benchmark.where(F.col("text").isNotNull()).select(F.col("item_id").cast("long").alias("item_id"), "text")
    blocks = max(1, math.ceil(items.count() / params.block_items * 1.1))
    found = None
    for k in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).collect()
        block = sorted((r["item_id"] if r["item_id"] is not None else -1, fold(r["text"])) for r in rows)
        part = _block_leaks(texts, [x for x in block if len(x[1]) >= params.min_chars], params)
        found = part if found is None else found.union(part)
    return found
