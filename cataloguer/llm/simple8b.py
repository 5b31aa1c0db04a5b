"""Simple-8b word-aligned integer coding, vectorised with numpy.

A 64-bit word holds a 4-bit selector (lowest bits) and 60 payload bits. The
selector names how many values of how many bits follow, lowest bits first;
selector 15 is the escape: the word's payload is unused and the next word is one
raw 64-bit value. At each position the fullest selector is taken whose values
all fit (values missing at the end of a block count as 0).
"""

from __future__ import annotations

import numpy as np

# (values per word, bits per value) by selector
LAYOUT = [(60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7), (7, 8), (6, 10), (5, 12), (4, 15), (3, 20), (2, 30), (1, 60)]
ESCAPE = 15
_COUNT = np.array([c for c, _ in LAYOUT] + [0, 1], np.int64)


def encode(values: np.ndarray) -> np.ndarray:
    """Words (uint64) of one block of unsigned values of up to 64 bits."""
    v = np.ascontiguousarray(values, dtype=np.uint64)
    n = len(v)
    if not n:
        return np.zeros(0, np.uint64)
    choice = np.full(n, ESCAPE, np.int8)
    bits_of = np.zeros(n, np.int8)
    for _, bits in LAYOUT:
        bits_of += v >= np.uint64(1 << bits)  # index of the first layout whose bits hold the value
    at = np.arange(n, dtype=np.int32)
    for k in range(len(LAYOUT) - 1, -1, -1):
        # next position from here on whose value needs more bits than layout k has
        wide = np.where(bits_of > k, at, np.int32(n + 64))
        wide = np.minimum.accumulate(wide[::-1])[::-1]
        choice[wide - at >= LAYOUT[k][0]] = k
        if not (bits_of <= k).any():
            break
    step = (at + _COUNT[choice]).tolist()
    first, i = [], 0
    while i < n:
        first.append(i)
        i = step[i]
    first = np.array(first, np.int64)
    sel = choice[first].astype(np.int64)
    width = 1 + (sel == ESCAPE)
    where = np.cumsum(width) - width
    out = np.zeros(int(width.sum()), np.uint64)
    out[where] = sel.astype(np.uint64)
    padded = np.concatenate([v, np.zeros(64, np.uint64)])
    for k, (count, bits) in enumerate(LAYOUT):
        rows = np.flatnonzero(sel == k)
        if len(rows):
            word = np.full(len(rows), k, np.uint64)
            for j in range(count):
                word |= padded[first[rows] + j] << np.uint64(4 + j * bits)
            out[where[rows]] = word
    raw = np.flatnonzero(sel == ESCAPE)
    out[where[raw] + 1] = v[first[raw]]
    return out


def decode(words: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` values (uint64) of a block."""
    w = np.ascontiguousarray(words, dtype=np.uint64)
    if not n:
        return np.zeros(0, np.uint64)
    sel = (w & np.uint64(15)).astype(np.int64)
    if (sel == ESCAPE).any():
        # an escape's second word is data: walk the runs of candidate escapes in order
        head = np.ones(len(w), bool)
        for i in np.flatnonzero(sel == ESCAPE).tolist():
            if head[i]:
                head[i + 1] = False
        at = np.flatnonzero(head)
        sel = sel[at]
    else:
        at = np.arange(len(w))
    count = _COUNT[sel]
    first = np.cumsum(count) - count
    out = np.zeros(int(count.sum()) + 64, np.uint64)
    for k, (c, bits) in enumerate(LAYOUT):
        rows = np.flatnonzero(sel == k)
        if len(rows):
            word, mask = w[at[rows]], np.uint64((1 << bits) - 1)
            for j in range(c):
                out[first[rows] + j] = (word >> np.uint64(4 + j * bits)) & mask
    raw = np.flatnonzero(sel == ESCAPE)
    out[first[raw]] = w[at[raw] + 1]
    return out[:n]
