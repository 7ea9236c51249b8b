"""Corpus pipeline: classify, remove repeated lines, drop near-duplicates, decontaminate, pack.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir)
and returns a DataFrame that is written as Parquet and read again as the next
stage's documents. All but the last return the columns of ``documents``.
``run`` applies them to ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from memweave.llm import decontaminate, linededup, neardup, packing, quality
from memweave.llm.joins import without_ids
from memweave.session import materialize
from memweave.sources.tables import load


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents whose junk and toxicity scores are both below one half."""
    judged = quality.classify(docs, load(spark, sf_dir, "labels"))
    return judged.filter("kept").select(*docs.columns)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Remove lines that repeat an earlier line (equal, or within the edit bound); a document that loses every word goes.

    ``n_chars`` becomes the length of the text that is left.
    """
    cleaned = linededup.drop_repeated_lines(docs)
    cleaned = cleaned.filter(r"n_removed = 0 or text rlike '[^\\x20\\x09-\\x0D]'")
    return cleaned.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("n_chars"))).select(*docs.columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the smallest id of each group of near-duplicates (five-word shingles, similarity 0.8)."""
    found = neardup.group_near_duplicates(docs, percent=80)
    dropped = materialize(found.filter("id <> component").select("id").distinct(), "dropped")
    return without_ids(docs, dropped).select(*docs.columns)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents that hold no benchmark item, verbatim or re-parameterised; each row is judged by its own text."""
    keyed = docs.withColumn("_row", decontaminate.row_key())
    found = decontaminate.leaks(keyed, load(spark, sf_dir, "benchmark"), id_col="_row")
    leaked = materialize(found.select("id").distinct(), "leaked")
    return without_ids(keyed, leaked, "_row").select(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Length bucket, batch and place of every document."""
    return packing.pack(docs)


STAGES = [
    ("quality_classifier", quality_stage),
    ("line_dedup", line_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]

#: Weak-label learning, signatures and dynamic programming have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
