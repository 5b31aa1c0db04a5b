"""Training-corpus pipeline: five of the operators of ``cataloguer.llm``, one after the other.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it works on all that
its predecessor kept. ``run`` writes each stage's result to the shared scratch folder
and reads it back for the next one, so an executor lost later repeats no stage. All
but the last return the columns of ``documents``.

Defined cases are the operators' own. A document without a single word after the
line stage (it held only repeats) goes; rows of equal doc_id go or stay together.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cataloguer.llm.decontaminate import find_leaks
from cataloguer.llm.jaccard_join import JaccardParams, jaccard_join
from cataloguer.llm.line_dedup import dedup_lines
from cataloguer.llm.packing import pack
from cataloguer.llm.quality import SPACES, quality_rules
from cataloguer.llm.registry import prepare, table, written

#: At 0.8 linked sets may differ in more slices than at 0.85, so slices are smaller and only empty ones are left out.
NEAR = JaccardParams(percent=80, words=5, weak=1)


def _whole(docs: DataFrame) -> DataFrame:
    """``docs`` as (doc_id, text, row): extra columns cannot clash with an operator's results."""
    return docs.select("doc_id", "text", F.struct(*[docs[c] for c in docs.columns]).alias("row"))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    judged = quality_rules(_whole(docs), table(spark, sf_dir, "labels"))
    return judged.where("kept").select(*[F.col("row")[c].alias(c) for c in docs.columns])


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without their repeated lines; ``n_chars`` follows the text."""
    out = dedup_lines(_whole(docs)).where((F.col("n_exact") + F.col("n_near") == 0) | (F.btrim("text", F.lit(SPACES)) != ""))
    new = {"text": F.col("text"), "n_chars": F.char_length("text").cast("long")}
    return out.select(*[new.get(c, F.col("row")[c]).alias(c) for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest doc_id."""
    groups = jaccard_join(docs, NEAR).where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    first = groups.select(F.col("doc_id").alias("first")).distinct()
    return docs.join(first, docs["doc_id"].eqNullSafe(first["first"]), "left_semi")


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    # written, so Spark knows its size and broadcasts it only below its own threshold
    leaks = written(find_leaks(docs, table(spark, sf_dir, "benchmark")).select("doc_id").distinct(), "pipeline-leaks")
    return docs.join(leaks, docs["doc_id"].eqNullSafe(leaks["doc_id"]), "left_anti")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in full sequences, mixed by source."""
    return pack(docs)


STAGES = [
    ("quality_rules", quality),
    ("line_dedup", lines),
    ("jaccard_join", near_duplicates),
    ("decontamination", decontaminate),
    ("packing", packing),
]

#: SQL cannot express the stages (hashed likelihood ratio, tokenizer); tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
