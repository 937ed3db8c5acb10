"""File states: unprocessed -> startedprocessing -> processed, or quarantined, kept as a table.

The ledger takes the place of moving objects between folders. It is keyed by source and file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.functions.scalars import has_document_suffix
from tallyspark.operators.upsert import upsert
from tallyspark.schemas import LEDGER

UNPROCESSED, STARTED, PROCESSED, QUARANTINED = "unprocessed", "startedprocessing", "processed", "quarantined"


def ledger_rows(
    files: DataFrame, source_id: int, state: Column, now: Column, outcome: Column | None = None
) -> DataFrame:
    """Ledger entries moving ``files`` (column ``file``) to ``state``."""
    return files.select(
        F.lit(source_id).alias("source_id"), "file", state.alias("state"),
        now.alias("last_modified"), (F.lit(None) if outcome is None else outcome).cast("string").alias("outcome"),
    ).select(*LEDGER.names)


def ledger_key() -> Column:
    return F.concat_ws("/", F.col("source_id").cast("string"), F.col("file"))


def move(ledger: DataFrame | None, changes: DataFrame) -> DataFrame:
    """The ledger after the given entries took effect; files never leave it."""
    def keyed(df: DataFrame) -> DataFrame:
        return df.withColumn("_key", ledger_key())

    return upsert(None if ledger is None else keyed(ledger), keyed(changes), "_key").drop("_key")


def requeue_stale(ledger: DataFrame, now: Column, hours: int = 1) -> DataFrame:
    """Put documents that have been in processing for longer than ``hours`` back in the queue."""
    age_limit = now - F.make_interval(hours=F.lit(hours))
    stale = (
        (F.col("state") == STARTED) & (F.col("last_modified") < age_limit) & has_document_suffix(F.col("file"))
    )
    return ledger.withColumn("state", F.when(stale, F.lit(UNPROCESSED)).otherwise(F.col("state")))
