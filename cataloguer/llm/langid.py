"""Language ID: blended-spectrum presence kernels, Nyström landmarks, one-versus-rest ridge regression.

A text is the set of its distinct character n-grams of lengths 1 to 3 (whole text,
letters of all scripts folded to lower case, every other character a blank), hashed to
``SPACE`` features. The kernel of two texts
is the number of n-grams both hold, over the geometric mean of their set sizes.
``landmarks`` training texts span a Nyström feature space; in it a ridge regression
per language fits 1 for its own texts and 0 for others. With the kernel values of a
batch of texts against the landmarks as a matrix, all scores are two matrix products.

The classifier is fitted on a bounded sample (documented parameters): of each
language the ``per_class`` labelled rows with the smallest hash of doc_id (then of the
text), of each all, or ``sample_windows`` windows spread evenly over the whole text, together
``sample_chars`` characters. Prediction uses the whole text of every document, and nothing else.

Defined cases: a null text, or one without letters, is ``und`` with score 0; equal
scores go to the alphabetically first language; rows are predicted each, repeated or
not; without any labelled row every prediction is ``und``; more than ``max_classes``
languages raise an error; other columns are not read.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_SPACE_BITS = 21
SPACE = 1 << _SPACE_BITS
_STEP, _SPREAD = np.uint32(0x01000193), np.uint32(0x9E3779B1)  # odd factors, products wrap modulo 2^32
_BATCH = 128


@dataclass(frozen=True)
class LangParams:
    """Production parameters; the first four bound the training sample."""

    per_class: int = 200
    sample_chars: int = 4000
    sample_windows: int = 4
    max_classes: int = 500
    landmarks: int = 192
    ridge: float = 1e-3


def letters() -> np.ndarray:
    """Per code point the lower-case letter's code point, 0 if it is no letter."""
    table = np.zeros(0x110000, np.uint32)
    for i in range(0x110000):
        c = chr(i)
        if unicodedata.category(c)[0] == "L":
            table[i] = ord(c.lower()[0])
    return table


class Grams:
    """Distinct n-grams of texts, by the position each n-gram is last written at."""

    def __init__(self, table: np.ndarray):
        self.table = table
        self.stamp = np.zeros(SPACE, np.int32)

    def distinct(self, text: str) -> np.ndarray:
        c = self.table[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")]
        if not c.any():
            return np.zeros(0, np.int32)
        two = (c[:-1] + np.uint32(1)) * _STEP + c[1:]
        three = (two[:-1] + np.uint32(2)) * _STEP + c[2:]
        codes = np.concatenate([c, two, three]) * _SPREAD
        codes ^= codes >> np.uint32(15)
        codes = ((codes * _STEP) >> np.uint32(32 - _SPACE_BITS)).astype(np.int32)
        at = np.arange(len(codes), dtype=np.int32)
        self.stamp[codes] = at
        return codes[self.stamp[codes] == at]


@dataclass
class LangModel:
    """Everything a task needs to score texts."""

    langs: list[str]
    table: np.ndarray
    feature: np.ndarray  # n-gram -> column, -1 where no landmark holds it
    landmarks: np.ndarray  # columns x landmarks, presence over the root of the landmark's size
    weights: np.ndarray  # landmarks x languages

    def scores(self, sets: list[np.ndarray]) -> np.ndarray:
        """Kernel values against the landmarks, then the regressions: two matrix products."""
        return kernel_rows(sets, self.feature, self.landmarks) @ self.weights


def kernel_rows(sets: list[np.ndarray], feature: np.ndarray, landmarks: np.ndarray) -> np.ndarray:
    """Normalised presence kernel of each n-gram set with each landmark."""
    x = np.zeros((len(sets), landmarks.shape[0]), np.float32)
    for i, s in enumerate(sets):
        f = feature[s]
        x[i, f[f >= 0]] = 1 / np.sqrt(max(1, len(s)))
    return x @ landmarks


def fit(sample: list[tuple[str, str]], params: LangParams = LangParams()) -> LangModel | None:
    """Fit on (lang, text) pairs, in order: the first of each language become landmarks."""
    if not sample:
        return None
    langs = sorted({l for l, _ in sample})
    grams = Grams(letters())
    pairs = [(l, s) for l, t in sample if len(s := grams.distinct(t))]
    if not pairs:
        return None
    share = max(1, params.landmarks // len(langs))
    chosen = [s for lang in langs for s in [s for l, s in pairs if l == lang][:share]]
    used = np.unique(np.concatenate(chosen))
    feature = np.full(SPACE, -1, np.int32)
    feature[used] = np.arange(len(used))
    marks = np.zeros((len(used), len(chosen)), np.float32)
    for j, s in enumerate(chosen):
        marks[feature[s], j] = 1 / np.sqrt(len(s))
    k = kernel_rows([s for _, s in pairs], feature, marks).astype(np.float64)
    kmm = kernel_rows(chosen, feature, marks).astype(np.float64)
    value, vector = np.linalg.eigh((kmm + kmm.T) / 2)
    good = value > 1e-6 * value[-1]
    to_space = vector[:, good] / np.sqrt(value[good])  # Nyström map
    phi = k @ to_space
    y = np.array([[float(l == lang) for lang in langs] for l, _ in pairs])
    w = np.linalg.solve(phi.T @ phi + params.ridge * len(pairs) * np.eye(phi.shape[1]), phi.T @ y)
    return LangModel(langs, grams.table, feature, marks, (to_space @ w).astype(np.float32))


def held_out(doc_id: str) -> Column:
    """Whether a document is in the held-out fold: crc32 of its id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def training_sample(docs: DataFrame, params: LangParams) -> list[tuple[str, str]]:
    """The bounded sample: rows are chosen by narrow keys, then only their texts are fetched.

    The keys are broadcast (at most ``per_class`` x ``max_classes``), so no text is shuffled. Equal
    rows count once, so ids that repeat often add no more than others.
    """
    docs = docs.select("doc_id", "lang", "text", F.xxhash64("text").alias("th"))
    rows = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & ~held_out("doc_id"))
    by_hash = Window.partitionBy("lang").orderBy("h", "doc_id", "th")
    keys = (
        rows.select("doc_id", "lang", "th", F.xxhash64("doc_id").alias("h")).distinct()
        .withColumn("rank", F.row_number().over(by_hash)).where(F.col("rank") <= params.per_class)
        .select("doc_id", "lang", "th").limit(params.per_class * params.max_classes + 1).collect()
    )
    if len({r["lang"] for r in keys}) > params.max_classes:
        raise ValueError(f"more than {params.max_classes} languages")
    if not keys:
        return []
    chosen = docs.sparkSession.createDataFrame([tuple(r) for r in keys], "_id long, _lang string, _th long")
    same = (F.col("doc_id") == F.col("_id")) & (F.col("lang") == F.col("_lang")) & (F.col("th") == F.col("_th"))
    texts = (
        docs.join(F.broadcast(chosen), same).select("lang", F.xxhash64("doc_id").alias("h"), "doc_id", "th", spread("text", params).alias("text"))
        .groupBy("lang", "h", "doc_id", "th").agg(F.min("text").alias("text")).collect()
    )
    return [(r["lang"], r["text"]) for r in sorted(texts, key=lambda r: (r["h"], r["doc_id"], r["lang"], r["th"]))]


def spread(text: str, params: LangParams) -> Column:
    """A text, or of a longer one windows spread evenly over all of it, from its first to its last character."""
    n, parts = F.char_length(text), params.sample_windows
    size = params.sample_chars // parts
    windows = [F.substring(text, F.floor((n - size) * k / max(1, parts - 1)).cast("int") + 1, F.lit(size)) for k in range(parts)]
    return F.when(n <= params.sample_chars, F.col(text)).otherwise(F.concat_ws(" ", *windows))


def predict(docs: DataFrame, model: LangModel | None) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for every row of ``docs``."""
    schema = "doc_id long, held_out boolean, lang_pred string, score double"

    def classify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = Grams(model.table) if model else None
        for b in batches:
            for lo in range(0, b.num_rows, _BATCH):
                part = b.slice(lo, _BATCH)
                pred, score = ["und"] * part.num_rows, [0.0] * part.num_rows
                if model:
                    sets = [grams.distinct(t.as_py() or "") for t in part.column(2)]
                    at = [i for i, s in enumerate(sets) if len(s)]
                    if at:
                        s = model.scores([sets[i] for i in at])
                        for i, k, v in zip(at, s.argmax(axis=1).tolist(), np.clip(s.max(axis=1), 0, 1).tolist()):
                            pred[i], score[i] = model.langs[k], v
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(pred, pa.string()), pa.array(score, pa.float64())],
                    ["doc_id", "held_out", "lang_pred", "score"],
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out("doc_id").alias("held_out"), "text")
    return rows.mapInArrow(classify, schema)


def identify_languages(docs: DataFrame, params: LangParams = LangParams()) -> DataFrame:
    """Fit on the bounded sample of ``docs``, predict all of them."""
    return predict(docs, fit(training_sample(docs, params), params))
