"""A scheduled run: ingest every source, rebuild the star, test it, publish it."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.functions.scalars import file_name
from tallyspark.operators.dedup import latest_per_key
from tallyspark.operators.extract import Extractor
from tallyspark.operators.quality import DataQualityError, gate
from tallyspark.plans.gold import star
from tallyspark.schemas import GOLD_DB, SILVER_DB
from tallyspark.sources.ddl import create_schema, publish_table
from tallyspark.sources.files import MAX_FILES_PER_BATCH
from tallyspark.sources.ledger import PROCESSED, STARTED, UNPROCESSED, requeue_stale
from tallyspark.sources.registry import SOURCES, source_spec
from tallyspark.streaming.ingest import Layout, close_run, file_states, ingest_stream, open_run, run_stream, test_batch

OUTCOMES = "source_id int, status string, processed bigint, rejected bigint, problem string"


@dataclass
class Run:
    """Where a run reads and writes. ``folders`` and ``extractors`` are given by source id.

    ``archives`` takes, by source id, folders that loaded files are moved to. ``on_fail`` says what a batch that fails
    a data test does: "stop" its source for this run, or leave it in quarantine and "continue" with the next one.
    """

    spark: SparkSession
    root: str
    folders: Mapping[int, str]
    extractors: Mapping[int, Callable[[], Extractor]]
    database: str = GOLD_DB
    max_files: int = MAX_FILES_PER_BATCH
    buckets: int = 256
    archives: Mapping[int, str] = field(default_factory=dict)
    on_fail: str = "stop"
    problems: dict[int, str] = field(default_factory=dict)

    def layout(self, source_id: int) -> Layout:
        return Layout(self.root, source_spec(source_id), self.buckets)

    def ingest(self) -> None:
        """Ingest each source. A failing one is noted and the next one still runs.

        Sources that may not be handled at all, for want of a document model, fail the run.
        """
        for source_id in sorted(self.folders):
            spec = source_spec(source_id)
            try:
                ingest_stream(
                    self.spark, spec, self.folders[source_id], self.root, self.extractors[source_id], self.max_files,
                    self.archives.get(source_id), self.buckets, self.on_fail,
                ).awaitTermination()
                close_run(self.spark, self.layout(source_id))
            except Exception as failure:
                self.problems[source_id] = f"{type(failure).__name__}: {failure}"

    def silver(self, versions: Mapping[int, int]) -> dict[int, DataFrame]:
        return {i: self.layout(i).store(self.spark).read("silver", at=n) for i, n in versions.items()}

    def publish(self, version: str) -> DataFrame:
        """Rebuild the star from silver, test both and let readers see it only if all tests pass.

        If tests fail, each source is tested by itself: one that fails is noted and taken as it was when last published,
        or left out if it never was, and the others are published.
        """
        current = {i: self.layout(i).store(self.spark).version().number for i in SOURCES}
        current = {i: n for i, n in current.items() if n}
        if not current:
            raise RuntimeError("no source has been ingested yet")
        try:
            gold, report = self._build(current, version)
        except DataQualityError as failure:
            good = self._passing(current)
            if good == current or not good:
                raise failure
            current = good
            gold, report = self._build(current, f"{version}-passed")
        create_schema(self.spark, self.database, f"{self.root}/published")
        for name, (path, df) in gold.items():
            publish_table(self.spark, f"{self.database}.{name}", df.schema, path)
        for source_id, number in current.items():
            self._keep(source_id, number)
        return report

    def _build(self, versions: Mapping[int, int], name: str) -> tuple[dict[str, tuple[str, DataFrame]], DataFrame]:
        """Write the star of these versions of the sources and test it."""
        silver, gold = self.silver(versions), {}
        for table, df in star(silver).items():
            path = f"{self.root}/gold/{table}/version={name}"
            df.write.mode("overwrite").parquet(path)
            gold[table] = (path, self.spark.read.schema(df.schema).parquet(path))
        tables = {f"{SILVER_DB}.{SOURCES[i].silver_table}": df for i, df in silver.items()}
        return gold, gate(tables | {f"{GOLD_DB}.{table}": df for table, (_, df) in gold.items()})

    def _passing(self, versions: Mapping[int, int]) -> dict[int, int]:
        good = {}
        for source_id, number in versions.items():
            store = self.layout(source_id).store(self.spark)
            try:
                test_batch(store.read("silver", at=number), source_spec(source_id))
                good[source_id] = number
            except DataQualityError as failure:
                self.problems[source_id] = f"{type(failure).__name__}: {failure}"
                last = store.version().values.get("keep")
                if last:
                    good[source_id] = last[0]
        return good

    def _keep(self, source_id: int, number: int) -> None:
        """Have the store keep the published version until another one is published."""
        batch = self.layout(source_id).store(self.spark).transaction()
        if batch.values.get("keep") != [number]:
            batch.values["keep"] = [number]
            batch.commit()

    def outcomes(self) -> DataFrame:
        """One row per source: files done, files to retry and what stopped it, if anything did."""
        rows = []
        for source_id in sorted(self.folders):
            ledger = file_states(self.spark, self.root, source_spec(source_id))
            counted = {} if ledger is None else {
                r["state"]: r["n"] for r in ledger.groupBy("state").agg(F.count(F.lit(1)).alias("n")).collect()
            }  # four states at most
            problem = self.problems.get(source_id)
            rows.append((source_id, "failed" if problem else "done",
                         counted.get(PROCESSED, 0), counted.get(STARTED, 0), problem))
        return self.spark.createDataFrame(rows, OUTCOMES)

    def retry_stale(self, source_id: int, now: Column) -> int:
        """Load again the files that have been in processing for over an hour; returns how many.

        They make a run of their own, in portions of ``max_files`` as new files do.
        """
        layout, extractor = self.layout(source_id), self.extractors[source_id]
        store = layout.store(self.spark)
        version = store.version()
        if "queue" in version.values.get("run", {}):  # finish what was left first
            run_stream(self.spark, layout, extractor, self.on_fail, self.archives.get(source_id)).awaitTermination()
            close_run(self.spark, layout)
            version = store.version()
        due = requeue_stale(store.read("ledger", at=version), now).filter(F.col("state") == UNPROCESSED).select("file")
        seen = store.read("seen", at=version).withColumn("file", file_name(F.col("path")))
        files = latest_per_key(seen.join(due, "file", "left_semi"), ["file"], ["-modificationTime", "path"])
        taken = open_run(self.spark, layout, files, self.max_files)
        if not taken:
            return 0
        run_stream(self.spark, layout, extractor, self.on_fail, self.archives.get(source_id)).awaitTermination()
        close_run(self.spark, layout)
        return taken


def run_all(run: Run, version: str) -> DataFrame:
    """Ingest, publish and report. A failed test leaves the published tables as they were."""
    run.problems.clear()
    run.ingest()
    try:
        run.publish(version)
    except Exception as failure:
        for source_id in run.folders:
            run.problems.setdefault(source_id, f"{type(failure).__name__}: {failure}")
    return run.outcomes()
