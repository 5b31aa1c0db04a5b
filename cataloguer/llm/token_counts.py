"""Token counts: unigram segmentation of distinct pre-tokens over a shared trie.

The tokenizer is a unigram model over the byte strings of a public vocabulary.
The vocabulary has ranks, not probabilities, and tokenizers are not trained here,
so a piece of rank r gets the Zipf probability proportional to ``1 / (r + shift)``.
Log-probabilities are whole millionths of a nat, so scores are exact and ties are
real ties (the segmentation with fewer tokens wins).

A task takes the pre-tokens of its texts chunk by chunk. Pre-tokens not seen before
are inserted in a trie and the forward recursion (best score and number of tokens
of each prefix) runs over the trie, once per node: a prefix that many pre-tokens
share is scored once. Sorted insertion visits the trie depth first, so only the
current path is held, and what stays is the count at each terminal. Every text is
then a sum of terminal counts. The store of terminal counts is bounded by
``MEMO_WORDS`` and emptied when full. There is no shuffle.

Defined cases: null or empty text has 0 pre-tokens and 0 tokens; repeated rows are
counted each; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import base64
import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import plain_texts, pretoken_starts
from .bytesops import WordIndex, prefix_hash, span_hash, text_chunks

MEMO_WORDS = 3_000_000
MICRO = 1_000_000
_SCHEMA = "doc_id long, n_pretokens long, n_tokens long"


def default_vocabulary() -> str:
    """Path of the public 50k byte-level vocabulary as ranks; read in place, never copied."""
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.tiktoken"))


def piece_scores(path: str, shift: float = 2.7) -> dict[bytes, int]:
    """Log-probability of each piece in millionths, by Zipf's law over the ranks."""
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    for b in range(256):  # every byte is a piece, so every text has a segmentation
        ranks.setdefault(bytes([b]), len(ranks))
    norm = math.log(sum(1 / (r + shift) for r in ranks.values()))
    return {p: round(MICRO * (-math.log(r + shift) - norm)) for p, r in ranks.items()}


class UnigramTrie:
    """Terminal token counts of words, by the forward recursion over their trie."""

    def __init__(self, scores: dict[bytes, int]):
        # trie of the vocabulary: (node * 256 + byte) -> node; node 0 is the root
        self.child: dict[int, int] = {}
        self.score: list[int | None] = [None]
        for piece, s in scores.items():
            node = 0
            for b in piece:
                nxt = self.child.get(node << 8 | b)
                if nxt is None:
                    nxt = self.child[node << 8 | b] = len(self.score)
                    self.score.append(None)
                node = nxt
            self.score[node] = s

    def counts(self, words: list[bytes]) -> list[int]:
        """Number of tokens of the best segmentation of each word; ``words`` are sorted and distinct."""
        child, score = self.child.get, self.score
        # path[d]: best score and fewest tokens of the first d bytes, and the pieces under way there
        path: list[tuple[int, int, list[tuple[int, int, int]]]] = [(0, 0, [])]
        out, last = [], b""
        for word in words:
            shared, most = 0, min(len(word), len(last))
            while shared < most and word[shared] == last[shared]:
                shared += 1
            del path[shared + 1 :]
            total, tokens, going = path[-1]
            for b in word[shared:]:
                alive, top, fewest = [], None, 0
                for node, s, n in (*going, (0, total, tokens)):
                    node = child(node << 8 | b)
                    if node is not None:
                        alive.append((node, s, n))
                        own = score[node]
                        if own is not None and (top is None or s + own > top or s + own == top and n + 1 < fewest):
                            top, fewest = s + own, n + 1
                total, tokens, going = top, fewest, alive
                path.append((total, tokens, going))
            out.append(tokens)
            last = word
        return out


class PretokenCounter:
    """Counts per text of a chunk; terminal counts stay known between chunks."""

    def __init__(self, path: str):
        import public_tokenizers
        import regex

        self._pattern = regex.compile(public_tokenizers.PATTERN)
        self._trie = UnigramTrie(piece_scores(path))
        self._forget()

    def _forget(self) -> None:
        self._index, self._known = WordIndex(), np.zeros(0, np.int64)

    def starts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Starts of all pre-tokens; texts outside the vectorised cut go through the pattern itself."""
        plain = plain_texts(data, offsets, [])
        if plain.all():
            return pretoken_starts(data, offsets) if len(data) else np.zeros(0, np.int64)
        raw, parts = data.tobytes(), []
        for i, p in enumerate(plain):
            a, b = offsets[i], offsets[i + 1]
            if p:
                parts.append(a + pretoken_starts(data[a:b], np.array([0, b - a])))
            else:
                sizes = [len(w.encode()) for w in self._pattern.findall(raw[a:b].decode())]
                parts.append(a + np.cumsum([0, *sizes[:-1]], dtype=np.int64))
        return np.concatenate(parts)

    def chunk(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(pre-tokens, tokens) per text."""
        starts = self.starts(data, offsets)
        at = np.searchsorted(starts, offsets)
        if not len(starts):
            return np.diff(at), np.diff(at)
        ends = np.append(starts[1:], len(data))
        h = span_hash(prefix_hash(data), starts, ends, data)
        known = self._index.lookup(h, data, starts)
        new = np.flatnonzero(known == -1)
        raw = data.tobytes()
        if len(new):
            hashes, first = np.unique(h[new], return_index=True)
            if len(self._index) and len(self._index) + len(hashes) > MEMO_WORDS:
                self._forget()
                hashes, new = np.unique(h, return_index=True)
                first = np.arange(len(new))
            pairs = sorted(zip((raw[a:b] for a, b in zip(starts[new[first]].tolist(), ends[new[first]].tolist())), hashes.tolist()))
            self._known = np.concatenate([self._known, np.array(self._trie.counts([w for w, _ in pairs]), np.int64)])
            self._index.add(np.array([x for _, x in pairs], np.uint64), [w for w, _ in pairs])
            known = self._index.lookup(h, data, starts)
        counts = self._known[known]
        for k in np.flatnonzero(known < 0).tolist():  # its hash belongs to another pre-token
            counts[k] = self._trie.counts([raw[starts[k] : ends[k]]])[0]
        sums = np.concatenate([[0], np.cumsum(counts)])
        return np.diff(at), np.diff(sums[at])


@lru_cache(maxsize=2)
def _counter(path: str) -> PretokenCounter:
    return PretokenCounter(path)


def token_counts(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """(doc_id, n_pretokens, n_tokens) of every text of ``docs``."""
    path = vocabulary or default_vocabulary()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(path)
        for b in batches:
            for lo, hi, data, offsets in text_chunks(b.column(1)):
                words, tokens = counter.chunk(data, offsets)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, hi - lo), pa.array(words, pa.int64()), pa.array(tokens, pa.int64())],
                    ["doc_id", "n_pretokens", "n_tokens"],
                )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(count, _SCHEMA)
