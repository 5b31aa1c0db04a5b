"""Suffix arrays by induced sorting, and permuted longest common prefixes."""

from __future__ import annotations

import numpy as np

from .bytesops import prefix_hash, span_hash


def _induce(sizes: np.ndarray, larger: list[int], smaller: list[int], seeds: np.ndarray, buckets: np.ndarray, last: int) -> list[int]:
    """Sort all suffixes from sorted leftmost-smaller seeds: larger types forward, smaller types backward.

    ``larger[i]`` and ``smaller[i]`` are the bucket of suffix i - 1 if that has the type, else -1; a last
    entry of -1 serves the places (-1) not filled yet. ``buckets`` are the seeds' buckets, ``last`` the
    bucket of the last suffix, which the end of the text induces.
    """
    n = len(larger) - 1
    ends = np.cumsum(sizes)
    start = ends - sizes
    sa = np.full(n, -1, np.int64)
    # seeds fill the ends of their buckets, in order
    order = np.argsort(buckets, kind="stable")
    held = np.bincount(buckets, minlength=len(sizes))
    rank = np.arange(len(seeds)) - np.repeat(np.cumsum(held) - held, held)
    sa[(ends - held)[buckets[order]] + rank] = seeds[order]
    sa = sa.tolist()
    head = start.tolist()
    sa[head[last]] = n - 1
    head[last] += 1
    for i in sa:
        c = larger[i]
        if c >= 0:
            k = head[c]
            sa[k] = i - 1
            head[c] = k + 1
    tail = ends.tolist()
    for k in range(n - 1, -1, -1):
        i = sa[k]
        c = smaller[i]
        if c >= 0:
            j = tail[c] - 1
            sa[j] = i - 1
            tail[c] = j
    return sa


def suffix_array(values: np.ndarray) -> np.ndarray:
    """Positions of the suffixes of ``values`` (non-negative whole numbers) in sorted order."""
    v = np.asarray(values, np.int64)
    n = len(v)
    if n < 2:
        return np.arange(n)
    sizes = np.bincount(v)
    # small[i]: suffix i is smaller than suffix i + 1; equal neighbours take the type to their right
    differs = np.flatnonzero(v[1:] != v[:-1])
    small = np.zeros(n, bool)
    if len(differs):
        nearest = np.searchsorted(differs, np.arange(n - 1))
        known = nearest < len(differs)
        at = differs[nearest[known]]
        small[: n - 1][known] = v[at] < v[at + 1]
    left = np.zeros(n, bool)  # leftmost smaller: a smaller type after a larger one
    left[1:] = small[1:] & ~small[:-1]
    seeds = np.flatnonzero(left)
    larger, smaller = np.full(n + 1, -1, np.int64), np.full(n + 1, -1, np.int64)
    larger[1:n] = np.where(small[:-1], -1, v[:-1])
    smaller[1:n] = np.where(small[:-1], v[:-1], -1)
    larger, smaller, last = larger.tolist(), smaller.tolist(), int(v[-1])
    rough = np.array(_induce(sizes, larger, smaller, seeds, v[seeds], last))
    if len(seeds) < 2:
        return rough
    # leftmost-smaller substrings are in order now; equal ones get one name
    order = rough[left[rough]]
    stop = np.zeros(n, np.int64)
    stop[seeds] = np.append(seeds[1:] + 1, n + 1)  # the last one ends with the text and equals none
    prefix = prefix_hash(np.append(v, 0))
    own = span_hash(prefix, order, np.minimum(stop[order], n + 1))
    fresh = np.ones(len(order), bool)
    fresh[1:] = (own[1:] != own[:-1]) | (stop[order[1:]] - order[1:] != stop[order[:-1]] - order[:-1])
    fresh[1:] |= (order[1:] == seeds[-1]) | (order[:-1] == seeds[-1])
    names = np.zeros(n, np.int64)
    names[order] = np.cumsum(fresh) - 1
    reduced = names[seeds]
    ranks = np.argsort(reduced) if fresh.all() else suffix_array(reduced)
    sorted_seeds = seeds[ranks]
    return np.array(_induce(sizes, larger, smaller, sorted_seeds, v[sorted_seeds], last))


def permuted_lcp(values: np.ndarray, sa: np.ndarray, stop: np.ndarray, most: int) -> np.ndarray:
    """By text position: common prefix (up to ``most``) of a suffix with the one before it in ``sa``.

    ``stop[i]`` is the end of the piece that holds position i: no prefix reaches over it.
    """
    n = len(values)
    prior = np.full(n, -1, np.int64)
    prior[sa[1:]] = sa[:-1]
    text, before, ends = np.asarray(values).tolist(), prior.tolist(), stop.tolist()
    out, h = [0] * n, 0
    for i in range(n):
        j = before[i]
        if j < 0:
            h = 0
            continue
        limit = min(most, ends[i] - i, ends[j] - j)
        if h > limit:
            h = limit
        while h < limit and text[i + h] == text[j + h]:
            h += 1
        out[i] = h
        if h:
            h -= 1
    return np.array(out, np.int64)
