"""Byte-level BPE ids through the ``tokenizers`` library, one encode per distinct pre-token.

A byte-level BPE never merges across pre-token boundaries, so the ids of a text
are the ids of its pre-tokens in order, and texts repeat the same pre-tokens
again and again. The library encodes each distinct pre-token once per worker; a
hash index over span hashes (64 bits) finds the ids again, vectorised over the
bytes of a whole chunk of texts, and compares the bytes. A text with a pre-token whose
hash belongs to another one goes through the library as a whole. The index is bounded by
``MEMO_WORDS``; when full it is emptied, which changes the time, never the ids.

Pre-tokens are cut vectorised in texts of ASCII (without apostrophes, which start
contractions) and Latin letters U+00C0-U+024F. Every other text, and each text
that holds the string of an added token, goes through the library as a whole.
"""

from __future__ import annotations

import os
from functools import lru_cache

import numpy as np
import pyarrow as pa

from .bytesops import WordIndex, flat_ranges, prefix_hash, span_hash, text_chunks

MEMO_WORDS = 2_000_000
_JOIN = 500

_SPACE, _LETTER, _NUMBER, _OTHER = 0, 1, 2, 3
_KIND = np.full(256, _OTHER, np.uint8)
_KIND[[9, 10, 11, 12, 13, 32]] = _SPACE
_KIND[48:58] = _NUMBER
_KIND[65:91] = _KIND[97:123] = _KIND[128:] = _LETTER
_ODD = np.zeros(256, bool)  # bytes that send a text to the library as a whole
_ODD[39] = True
_ODD[0xC0:0xC3] = _ODD[0xCA:] = True


def pretoken_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Start positions of the pre-tokens of plain texts laid out back to back (see module)."""
    kind = _KIND[data]
    start = np.empty(len(data), bool)
    start[:1] = True
    np.not_equal(kind[1:], kind[:-1], out=start[1:])
    first = np.zeros(len(data), bool)
    first[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
    start |= first
    after = np.flatnonzero(start[1:] & (kind[1:] != _SPACE) & (kind[:-1] == _SPACE) & ~first[1:]) + 1
    start[after - 1] = True  # the last white space before a word stands alone or, if a blank, leads it
    start[after[data[after - 1] == 32]] = False
    return np.flatnonzero(start)


def plain_texts(data: np.ndarray, offsets: np.ndarray, added: list[bytes]) -> np.ndarray:
    """Which texts the vectorised cut covers."""
    odd = _ODD[data]
    odd[1:] |= (data[:-1] == 0xC3) & ((data[1:] == 0x97) | (data[1:] == 0xB7))
    seen = np.concatenate([[0], np.cumsum(odd)])
    plain = seen[offsets[1:]] == seen[offsets[:-1]]
    raw = data.tobytes()
    for token in added:
        at = raw.find(token)
        while at >= 0:
            plain[np.searchsorted(offsets, at, "right") - 1] = False
            at = raw.find(token, at + 1)
    return plain


class _Collision(Exception):
    """Texts that hold a pre-token with the hash of another."""

    def __init__(self, texts: np.ndarray):
        self.texts = texts


class WordEncoder:
    """``encode_chunk`` turns the texts of a chunk into ids; the index of known pre-tokens stays."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tok = Tokenizer.from_file(path)
        self._added = [t.content.encode() for t in self._tok.get_added_tokens_decoder().values()]
        self._forget()

    def _forget(self) -> None:
        self._index = WordIndex()
        self._ids = np.zeros(1 << 16, np.uint32)
        self._first = np.zeros(1, np.int64)  # start of each known pre-token's ids, and the end

    def _learn(self, hashes: np.ndarray, words: list[str]) -> None:
        """Encode new distinct pre-tokens. Those of a blank and letters are joined: the library cuts them again."""
        lengths = np.zeros(len(words), np.int64)
        parts: list[np.ndarray] = []
        joined = np.array([len(w) > 1 and w[0] == " " and w[1:].isalpha() for w in words], bool)
        order = np.concatenate([np.flatnonzero(joined), np.flatnonzero(~joined)])
        n = int(joined.sum())
        texts = ["".join(words[i] for i in order[a : min(a + _JOIN, n)]) for a in range(0, n, _JOIN)]
        for k, e in enumerate(self._tok.encode_batch(texts, add_special_tokens=False)):
            ids, word = np.array(e.ids, np.uint32), np.array(e.word_ids, np.int64)
            a, b = k * _JOIN, min((k + 1) * _JOIN, n)
            lengths[a:b] = np.bincount(word, minlength=b - a)
            if len(lengths[a:b]) != b - a or lengths[a:b].sum() != len(ids):
                raise ValueError("joined pre-tokens were cut in another way")
            parts.append(ids)
        for k, e in enumerate(self._tok.encode_batch_fast([words[i] for i in order[n:]], add_special_tokens=False)):
            ids = np.array(e.ids, np.uint32)
            lengths[n + k] = len(ids)
            parts.append(ids)
        new = np.concatenate(parts) if parts else np.zeros(0, np.uint32)
        end = self._first[-1]
        while end + len(new) > len(self._ids):
            self._ids = np.concatenate([self._ids, np.zeros(len(self._ids), np.uint32)])
        self._ids[end : end + len(new)] = new
        self._first = np.concatenate([self._first, end + np.cumsum(lengths)])
        self._index.add(hashes[order], [words[i].encode() for i in order])

    def _plain(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(offsets) - 1, np.int64)
        starts = pretoken_starts(data, offsets)
        ends = np.append(starts[1:], len(data))
        h = span_hash(prefix_hash(data), starts, ends, data)
        known = self._index.lookup(h, data, starts)
        new = np.flatnonzero(known == -1)
        if len(new):
            again = new
            hashes, at = np.unique(h[new], return_index=True)
            if len(self._index) + len(hashes) > MEMO_WORDS and len(self._index):
                self._forget()
                hashes, new = np.unique(h, return_index=True)
                at, again = np.arange(len(new)), np.arange(len(h))
            raw = data.tobytes()
            s, e = starts[new[at]].tolist(), ends[new[at]].tolist()
            self._learn(hashes, [raw[a:b].decode() for a, b in zip(s, e)])
            sizes = (ends - starts)[again]
            known[again] = self._index.lookup(h[again], data[flat_ranges(starts[again], sizes)], np.cumsum(sizes) - sizes)
        if (known < 0).any():
            raise _Collision(np.unique(np.searchsorted(offsets, starts[known < 0], "right") - 1))
        first, lengths = self._first[known], (self._first[1:] - self._first[:-1])[known]
        counts = np.concatenate([[0], np.cumsum(lengths)])
        at = np.searchsorted(starts, offsets)
        return self._ids[flat_ranges(first, lengths)], np.diff(counts[at])

    def encode_chunk(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids (uint32) of the texts back to back, and the number of each text's ids."""
        plain = plain_texts(data, offsets, self._added)
        while True:
            try:
                return self._chunk(data, offsets, plain)
            except _Collision as c:
                plain[c.texts] = False

    def _chunk(self, data: np.ndarray, offsets: np.ndarray, plain: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if plain.all():
            return self._plain(data, offsets)
        sizes = np.diff(offsets)
        keep = np.repeat(plain, sizes)
        po = np.concatenate([[0], np.cumsum(np.where(plain, sizes, 0))])
        ids, counts = self._plain(data[keep], po)
        raw = data.tobytes()
        parts, done = [], 0
        for i in np.flatnonzero(~plain):
            upto = int(counts[:i].sum())  # counts of whole texts are still 0 here
            parts.append(ids[done:upto])
            done = upto
            text = raw[offsets[i] : offsets[i + 1]].decode()
            parts.append(np.array(self._tok.encode(text, add_special_tokens=False).ids, np.uint32))
        parts.append(ids[done:])
        for i, p in zip(np.flatnonzero(~plain), parts[1::2]):
            counts[i] = len(p)
        return np.concatenate(parts), counts

    def encode(self, column: pa.Array):
        """Yield (first row, end row, ids, counts) over a string column; a null text is empty."""
        for lo, hi, data, offsets in text_chunks(column):
            ids, counts = self.encode_chunk(data, offsets)
            yield lo, hi, ids, counts


@lru_cache(maxsize=2)
def word_encoder(path: str) -> WordEncoder:
    """One encoder (and index of known pre-tokens) per Python worker and vocabulary file."""
    return WordEncoder(path)


def default_vocabulary() -> str:
    """Path of the public 50k byte-level BPE vocabulary; it is read in place, never copied."""
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.json"))
