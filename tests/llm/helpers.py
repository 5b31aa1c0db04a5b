"""Small tables with every awkward case, and plain models of the operators' contracts."""

import re

WORD = re.compile("[^\x20\x09-\x0d]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"

BASE = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen"
LONG = " ".join(f"w{i % 997}x{i % 13}" for i in range(30_000))
EDGE_TEXTS = [
    None, "", "   \n\t ", "word", "two words", BASE, BASE.upper(), BASE, BASE + " tail", LONG, LONG + " end",
    "line one is long enough to count as text\n" * 4, "ünïcödé ÀÉ × ÷ ß 日本語 🎉 don't we'll '' 's\n\n  x  ", "a<|endoftext|>b <|im_end|>",
    "\x00\x1f\x0b\x0c\r mixed", "aaaa" * 400,
]


def edge_rows():
    """Rows with null columns, copies, ties, a repeated row and a repeated doc_id."""
    rows = [(i * 3, t, "en" if i % 2 else None, None if i % 4 == 0 else f"s{i % 3}", None if t is None else len(t)) for i, t in enumerate(EDGE_TEXTS)]
    return rows + [rows[5], rows[5], (15, "another text under a doc_id in use", "en", "s0", 1), (None, "a text without an id " * 9, "en", "s1", 2), (None, BASE, None, None, None)]


def edge_docs(spark, clash=()):
    """The edge rows; ``clash`` adds columns of these names."""
    from pyspark.sql import functions as F

    return spark.createDataFrame(edge_rows(), SCHEMA).select("*", *[F.lit("x").alias(c) for c in clash])


def rows_of(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)
