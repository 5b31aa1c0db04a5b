"""Quality rules: counting rules and a hashed n-gram log-likelihood ratio (native operations only).

Two multinomials over ``buckets`` hashed n-grams are counted over all documents:
the raw corpus, and all trusted documents (labelled quality 1 and not toxic). The
weight of a bucket is ``log((t + s) / (e + s))`` with ``t`` the trusted count, ``e``
the count expected if trusted text were like raw text, and ``s`` the smoothing that
draws rare buckets to 0. Weights within ``dead_zone`` of 0 count as 0: small
differences between two sound texts are noise. ``QualityRules()`` judges by the single
words that trusted text clearly avoids, and positive weights count as 0 too; ``RATIO``
is the ratio of both models over words and word pairs, with both signs. Each order of
n-grams has buckets and totals of its own, so one does not thin out the other; pairs
are rarer and many, so they take the greater ``pair_smoothing``. A document's
score is the mean weight of its n-grams; below ``threshold`` it is rejected.

Smoothing and dead zone together are a test of significance: with 3 and 0.5 no bucket
counts whose likelihood ratio ``2 (t log(t / e) - t + e)`` is under 2.6, about 5 % one-sided,
and about two expected occurrences are the least that can count. What is asked of the
evidence is the same in any corpus, so more labelled text weighs rarer words. A
smoothing that grew with the trusted total would give words under a fixed rate no
weight, however much text is labelled.

Weights are rounded to whole millionths, so sums are exact and every verdict is
the same in any order of evaluation. The weight table has ``buckets`` entries an order
whatever the corpus (its bound); Spark builds it and reads it as a scalar subquery.

Defined cases: a null or empty text has no words and fails the base rules;
repeated rows are judged each on its own; without trusted documents all weights
are 0; extra columns stay, but for those named like a result; a document whose label rows disagree is not trusted;
a null doc_id is never trusted.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.arrays import computed
from .lookup import dense_array, screen
from .registry import written

SPACES = " \t\n\x0b\x0c\r"
_SPACE_RUN = r"[\x20\x09-\x0D]+"
_SYMBOLS = r"[#*$%&|<>]"
MICRO = 1_000_000


@dataclass(frozen=True)
class QualityRules:
    """Production parameters."""

    buckets: int = 1 << 18
    orders: tuple[int, ...] = (1,)
    smoothing: float = 3.0
    pair_smoothing: float = 128.0  # of n-grams of two words or more
    dead_zone: float = 0.5
    two_sided: bool = False
    threshold: float = -0.03
    min_words: int = 50
    max_repeat_percent: int = 50


#: The ratio of the two models over words and pairs, with both signs. The mean is over both orders, so its threshold is half as wide.
RATIO = QualityRules(orders=(1, 2), two_sided=True, threshold=-0.015)


def words_of(text: Column) -> Column:
    """Array of the words ``[^\\x20\\x09-\\x0D]+`` of a text (empty for null)."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, _SPACE_RUN))


def _word_hashes(words: Column) -> Column:
    """Hash of each word, lower-cased."""
    return F.transform(words, lambda w: F.xxhash64(F.lower(w)))


def _bucket(k: int, hashes: list[Column], rules: QualityRules) -> Column:
    """Bucket of an n-gram of the k-th order, from the hashes of its words: those of an order lie from ``k * buckets`` on."""
    whole = hashes[0] if len(hashes) == 1 else F.xxhash64(*hashes)
    place = F.pmod(whole, F.lit(rules.buckets)).cast("int")
    return place + k * rules.buckets if k else place


def _grams(hashes: Column, rules: QualityRules) -> Column:
    """Buckets of the n-grams of an array of word hashes."""

    def single(k: int):
        return lambda h: _bucket(k, [h], rules)

    def pair(k: int):
        return lambda a, b: _bucket(k, [a, b], rules)

    def window(k: int, n: int):
        return lambda i: _bucket(k, [F.get(hashes, i + j) for j in range(n)], rules)

    parts = []
    for k, n in enumerate(rules.orders):
        if n == 1:
            parts.append(F.transform(hashes, single(k)))
            continue
        if n == 2:
            parts.append(F.zip_with(F.slice(hashes, 1, F.greatest(F.size(hashes) - 1, F.lit(0))), F.slice(hashes, 2, F.size(hashes)), pair(k)))
            continue
        at = F.when(F.size(hashes) >= n, F.sequence(F.lit(0), F.size(hashes) - n)).otherwise(F.array().cast("array<int>"))
        parts.append(F.transform(at, window(k, n)))
    return parts[0] if len(parts) == 1 else F.concat(*parts)


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Documents that every label row calls good and none calls toxic."""
    good = F.coalesce((F.col("quality") == 1) & (F.coalesce(F.col("toxic"), F.lit(0)) == 0), F.lit(False))
    return (
        labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min(good.cast("int")).alias("good"))
        .where("good = 1").select(F.col("doc_id").alias("_trusted_id"))
    )


def bucket_counts(docs: DataFrame, labels: DataFrame, rules: QualityRules) -> DataFrame:
    """(bucket, raw, trusted): counts over all documents; partial sums precede the shuffle.

    The ids are as many as the labels, so the join is a shuffle join. Only texts that
    the screen lets through take part; the others, all without an id among them, are not trusted.
    """
    ids = trusted_ids(labels)
    texts = docs.select(F.col("doc_id").alias("_id"), F.col("text").alias("_text"))
    likely = F.col("_id").isNotNull() & screen(ids.select(F.xxhash64("_trusted_id").alias("h")), "h")(F.xxhash64("_id"))
    joined = texts.where(likely).join(ids.hint("shuffle_hash"), F.col("_id") == F.col("_trusted_id"), "left")
    marked = joined.unionByName(texts.where(~likely).withColumn("_trusted_id", F.lit(None))).select(
        F.col("_trusted_id").isNotNull().cast("int").alias("trusted"), "_text"
    )
    if rules.orders == (1,):
        rows = marked.select("trusted", F.explode_outer(words_of(F.col("_text"))).alias("w")).select(
            "trusted", F.pmod(F.xxhash64(F.lower("w")), F.lit(rules.buckets)).cast("int").alias("bucket"), F.col("w").isNull().alias("none")
        ).where(~F.col("none"))
    else:
        # each word with those after it, as rows: hashes and buckets are then plain columns
        longest = max(rules.orders)
        listed = computed(marked, ["trusted"], [words_of(F.lower("_text")).alias("words")])
        follows = F.arrays_zip(*[F.slice("words", j + 1, F.size("words")).alias(f"w{j}") for j in range(longest)])
        at = listed.select("trusted", F.explode_outer(follows).alias("w")).select(
            "trusted", *[F.when(F.col(f"w.w{j}").isNotNull(), F.xxhash64(f"w.w{j}")).alias(f"h{j}") for j in range(longest)])
        buckets = [F.when(F.col(f"h{n - 1}").isNotNull(), _bucket(k, [F.col(f"h{j}") for j in range(n)], rules)) for k, n in enumerate(rules.orders)]
        rows = at.select("trusted", F.explode_outer(F.array(*buckets)).alias("bucket")).where(F.col("bucket").isNotNull())
    return rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("raw"), F.sum("trusted").alias("trusted"))


def weight_entries(counts: DataFrame, rules: QualityRules) -> DataFrame:
    """(at, value): the weights other than 0, in millionths, by bucket. Two sums an order reach the driver."""
    counts = written(counts, "quality-counts").withColumn("order", F.floor(F.col("bucket") / rules.buckets).cast("int"))
    sums = {r["order"]: r for r in counts.groupBy("order").agg(F.sum("raw").alias("raw"), F.sum("trusted").alias("trusted")).collect()}
    w = F.lit(None).cast("double")
    for k, n in enumerate(rules.orders):
        if k in sums and sums[k]["trusted"]:
            s = rules.smoothing if n == 1 else rules.pair_smoothing
            expected = F.col("raw") * F.lit(sums[k]["trusted"]) / F.lit(sums[k]["raw"])
            w = F.when(F.col("order") == k, F.log((F.col("trusted") + s) / (expected + s))).otherwise(w)
    rows = counts.select(F.col("bucket").cast("long").alias("at"), w.alias("w"))
    rows = rows.where((F.abs("w") if rules.two_sided else -F.col("w")) > rules.dead_zone)
    return rows.select("at", F.round(F.col("w") * MICRO).cast("int").alias("value"))


def judge(docs: DataFrame, weights: DataFrame, rules: QualityRules = QualityRules()) -> DataFrame:
    """``docs`` with the rule counts, ``llr`` (mean weight), ``base_failed`` and ``kept`` (they replace columns so named).

    ``weights``: ``weight_entries``.
    """
    results = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "llr", "base_failed", "kept"]
    keep = ["_row"]  # all input columns, as one: no name can clash with a step's
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("_row"))
    text = F.coalesce(F.col("_row.text"), F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    table = dense_array(weights, rules.buckets * len(rules.orders), "int")
    step = computed(rows, keep, [words_of(F.col("_row.text")).alias("_words"), lines.alias("_lines")])
    if rules.orders != (1,):
        step = computed(step, [*keep, "_words", "_lines"], [_word_hashes(F.col("_words")).alias("_hashes")])
    step = step.select("*", table.alias("_weights"))
    if rules.orders == (1,):
        total = F.aggregate("_words", F.lit(0).cast("long"), lambda a, w: a + F.get(
            F.col("_weights"), F.pmod(F.xxhash64(F.lower(w)), F.lit(rules.buckets)).cast("int")))
        grams = F.size("_words").cast("long")
    else:
        total = F.aggregate(_grams(F.col("_hashes"), rules), F.lit(0).cast("long"), lambda a, b: a + F.get(F.col("_weights"), b))
        grams = F.lit(0).cast("long")
        for k in rules.orders:
            grams = grams + F.greatest(F.size("_words") - (k - 1), F.lit(0))
    step = step.select(*keep, "_words", "_lines", total.alias("_total"), grams.alias("_grams"))
    carried = ["_words", "_lines", "_total", "_grams"]
    n = F.size("_words")
    windows = F.when(n >= 3, F.sequence(F.lit(0), n - 3)).otherwise(F.array().cast("array<int>"))
    step = step.select(
        *keep, *carried,
        F.sort_array(F.transform(windows, lambda i: F.struct(
            F.xxhash64(F.get("_words", i), F.get("_words", i + 1), F.get("_words", i + 2)).alias("h"), i.alias("i")
        ))).alias("_windows"),
    )

    def repeated(x: Column, i: Column) -> Column:
        near = lambda k: F.coalesce(F.get(F.col("_windows"), k)["h"] == x["h"], F.lit(False))
        return ((i > 0) & near(i - 1)) | near(i + 1)

    step = step.select(*keep, *carried, F.sort_array(F.transform(F.filter("_windows", repeated), lambda x: x["i"])).alias("_starts"))
    covered = F.aggregate(
        "_starts", F.struct(F.lit(0).cast("long").alias("n"), F.lit(-3).alias("last")),
        lambda a, p: F.struct((a["n"] + F.least(F.lit(3), p - a["last"])).alias("n"), p.alias("last")),
        lambda a: a["n"],
    )

    step = step.select(
        *keep,
        n.cast("long").alias("n_words"),
        F.char_length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        (F.char_length(text) - F.char_length(F.regexp_replace(text, _SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        covered.alias("n_repeat_words"), "_total", "_grams",
    )
    bad = (F.col("n_words") < rules.min_words) | (100 * F.col("n_repeat_words") > rules.max_repeat_percent * F.col("n_words"))
    limit = F.lit(round(rules.threshold * MICRO)).cast("long")
    # a generator is a barrier: a later filter on a verdict must not be pushed below the steps above,
    # where every reference would be replaced by the whole expression
    judged = step.select(*keep, F.inline_outer(F.array(F.struct(
        *results[:5],
        F.when(F.col("_grams") > 0, F.col("_total") / F.col("_grams") / MICRO).otherwise(0.0).alias("llr"),
        bad.alias("base_failed"),
        (~bad & (F.col("_total") >= limit * F.col("_grams"))).alias("kept"),
    ))))
    return judged.select(*[F.col("_row")[c].alias(c) for c in docs.columns if c.lower() not in results], *results)


def quality_rules(docs: DataFrame, labels: DataFrame, rules: QualityRules = QualityRules()) -> DataFrame:
    """Judge every document of ``docs`` (doc_id, text, ...) with weights counted over all of them."""
    return judge(docs, weight_entries(bucket_counts(docs, labels, rules), rules), rules)
