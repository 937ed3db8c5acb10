"""Exact deduplication against a persistent digest index.

The index is a table bucketed and sorted by digest. A batch is reduced to one row per digest before
it moves, anti-joined with the index by sort-merge in the index's own buckets (the history is never
shuffled), and what is new is appended.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.session import durable_path, staged

#: Characters that don't count when texts are compared: space and \t to \r.
BLANKS = " \t\n\x0b\x0c\r"


def normalised(text: Column) -> Column:
    """The text without blanks; NULL counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), BLANKS, "")


class DigestIndex:
    """One row per distinct text ever seen: its digest, the row that stays and the batch that brought it.

    ``path`` is a folder all executors reach. ``buckets`` is fixed for the life of an index; it
    defaults to the session's shuffle partitions, so that a first batch meets it without a second shuffle.
    The table can be opened again by path from any session.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int | None = None):
        self.spark, self.path = spark, path
        self.name = "digest_index_" + hashlib.sha256(path.encode()).hexdigest()[:16]
        buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} (digest BINARY, keep_id BIGINT, group_size BIGINT, batch STRING) "
            f"USING parquet CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{path}'")

    def rows(self) -> DataFrame:
        return self.spark.table(self.name)

    def deduplicate(self, docs: DataFrame, batch: str) -> DataFrame:
        """Append the new texts of ``docs`` (doc_id, text) and return one row per row of ``docs``.

        Returns doc_id, keep_id, group_size, kept, text_sha256. Of equal texts in a batch the one
        with most characters stays, then the smallest doc_id; NULL ids come last. Texts that an
        earlier batch brought stay with that batch's row. ``group_size`` counts the rows with the
        text in the batch that brought it. Rows that repeat both id and text share one decision.
        Other columns are ignored. Running a batch again changes nothing and gives the same answer.
        """
        read = staged(
            docs.select(
                F.col("doc_id").cast("long").alias("doc_id"),
                F.unhex(F.sha2(normalised(F.col("text")), 256)).alias("digest"),
                F.length(F.coalesce("text", F.lit(""))).cast("long").alias("chars"),
            ), "digests")
        first = F.min(F.struct((-F.col("chars")).alias("less"), F.col("doc_id").isNull().alias("unnamed"), "doc_id"))
        groups = read.groupBy("digest").agg(first.alias("first"), F.count(F.lit(1)).alias("group_size"))
        new = groups.join(self.rows().select("digest").hint("merge"), "digest", "left_anti").select(
            "digest", F.col("first.doc_id").alias("keep_id"), "group_size", F.lit(batch).alias("batch"))
        new.write.insertInto(self.name)
        self.spark.catalog.refreshTable(self.name)
        # The batch's own digests with their index rows, as a table: reading it leaves both sides of
        # the next join to exchanges, which AQE splits where one text holds a large share of rows.
        known = staged(self.rows().join(read.select("digest").distinct().hint("merge"), "digest"), "decisions")
        return read.join(known, "digest", "left").select(
            "doc_id", "keep_id", "group_size",
            ((F.col("batch") == batch) & F.col("doc_id").eqNullSafe(F.col("keep_id"))).alias("kept"),
            F.lower(F.hex("digest")).alias("text_sha256"))


def exact_dedup(docs: DataFrame) -> DataFrame:
    """Decisions for one table against an index of its own (see :meth:`DigestIndex.deduplicate`)."""
    spark = docs.sparkSession
    return DigestIndex(spark, durable_path(spark, "digest-index")).deduplicate(docs, "first")


ORACLE = r"""
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS chars,
                  sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, first_value(doc_id) OVER best AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id = first_value(doc_id) OVER best AS kept, text_sha256
FROM d WINDOW best AS (PARTITION BY text_sha256 ORDER BY chars DESC, doc_id)
"""
