"""A training corpus from ``documents``: filter, deduplicate, decontaminate and pack.

Every stage takes the rows that the one before it kept, as a table written and read again. All but the
last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyspark.llm import decontaminate, line_dedup, near_dedup, packing, toxicity
from tallyspark.llm.queries import table, vocabulary
from tallyspark.session import staged


def clean_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the toxicity network rejects; it learns from the labelled rows that are not held out."""
    return toxicity.keep_clean(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def unique_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without lines that are near copies of earlier ones."""
    return line_dedup.remove_lines(docs)


def unique_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return near_dedup.keep_first(docs)


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that hold a window of a benchmark item."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents and their places in training sequences."""
    return packing.pack(docs, vocabulary("word_bpe_49k.json"), end_id=2)


STAGES = [("toxicity", clean_language), ("line_dedup", unique_lines), ("near_dedup", unique_documents),
          ("decontamination", uncontaminated), ("packing", packed)]

#: SQL can't train a network; the stages are tested one by one against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
