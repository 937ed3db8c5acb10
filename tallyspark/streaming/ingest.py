"""From arriving files to silver tables, one batch at a time.

Each source has one ``Store`` below ``root/tables/<source>`` with these tables, which change together:

``bronze``      extracted documents
``documents``   the same documents parsed, so that history is never parsed again, by invoice
``silver``      merged invoice lines
``ledger``      state of each file
``seen``        versions of files that were taken up
``rejected``    failed or empty extractions with their error
``quarantine``  documents of batches that failed a data test, with the reason

A batch is written beside the tables, its lines are tested, and one new version of the store shows its data and
the states of its files, or, if a test failed, their states alone. Files come in runs: the listing without what
``seen`` has is written below ``root/queue`` in portions, each a batch of its own. Its checkpoint belongs
to that run, so it and the driver hold what one run found, whatever was loaded before.

A stream takes some portions at a time and works out in common passes what each of them by itself would have added, in
order. Only if any of them fails are they loaded one by one, so that no other is held back.
"""

from __future__ import annotations

import hashlib
import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from tallyspark.operators.dedup import latest_per_key
from tallyspark.operators.extract import Extractor, accepted, extract_documents, quarantined
from tallyspark.operators.quality import DataQualityError, gate
from tallyspark.operators.versioned import (
    DuplicateKeyError,
    Store,
    TableSpec,
    Transaction,
    delete_path,
    path_exists,
)
from tallyspark.plans.gold import star
from tallyspark.plans.silver import documents, documents_type, ds1_invoice_no, silver_ds1_lines, silver_ds2_lines
from tallyspark.schemas import BRONZE, EXTRACTED, GOLD_DB, LEDGER, LISTED, SEEN, SILVER_DB, TABLES
from tallyspark.session import discard, staged
from tallyspark.sources.bronze import bronze_envelope
from tallyspark.sources.files import MAX_FILES_PER_BATCH, in_portions, list_files, not_seen, read_files, with_file_name
from tallyspark.sources.ledger import PROCESSED, QUARANTINED, STARTED, UNPROCESSED, ledger_rows
from tallyspark.sources.registry import SourceSpec

# source id -> (what decides which documents an invoice line depends on, silver plan).
# Source 2 re-derives all documents of an order: its line key leaves out the client, and a
# conflict between two clients of one order must show up as such.
SILVER: dict[int, tuple[Callable[[], Column], Callable[..., DataFrame]]] = {
    1: (ds1_invoice_no, silver_ds1_lines),
    2: (lambda: F.col("order_id"), silver_ds2_lines),
}

LINE_KEY, INVOICE, PORTION = "unique_invoice_line_no", "_invoice", "portion"
PORTIONS_TOGETHER = 32  # most portions that are worked on in common; what a failure or a crash has done again
ROWS_IN_PLACE = 1000  # rows of a task for a bucket, on the average, that make a file of its own worth while
REJECTED = StructType([*EXTRACTED.fields, StructField("outcome", StringType())])
QUARANTINE = StructType([*BRONZE.fields, StructField("reason", StringType())])
QUEUED = StructType([*LISTED.fields, StructField(PORTION, IntegerType())])


@dataclass(frozen=True)
class Layout:
    """Where one source's tables live."""

    root: str
    spec: SourceSpec
    # Most buckets of a segment. Sized once for the whole source: a few hundred MB each.
    buckets: int = 256

    @property
    def folder(self) -> str:
        return f"{self.root}/tables/{self.spec.bucket}"

    def store(self, spark: SparkSession) -> Store:
        return Store(spark, self.folder, {
            "bronze": TableSpec(BRONZE, None, replace=False),
            "documents": TableSpec(documents_type(self.spec).add(INVOICE, StringType()), INVOICE, replace=False),
            "silver": TableSpec(TABLES[f"{SILVER_DB}.{self.spec.silver_table}"], LINE_KEY),
            "ledger": TableSpec(LEDGER, "file"),
            "seen": TableSpec(SEEN, "version", replace=False),
            "rejected": TableSpec(REJECTED, None, replace=False),
            "quarantine": TableSpec(QUARANTINE, None, replace=False),
        }, self.buckets)


def is_loaded(values: dict, stream: str, number: list[int]) -> bool:
    """Whether a batch of a stream, or a later one, is part of the tables. A shorter number stands for all that begin with it."""
    done = values.get("progress", {}).get(stream, [-1])
    return done >= number[: len(done)]


def _note_progress(batch: Transaction, stream: str, number: list[int]) -> None:
    batch.values["progress"] = {**batch.values.get("progress", {}), stream: number}


def _put_documents(batch: Transaction, layout: Layout, bronze: DataFrame) -> DataFrame:
    """Write bronze rows, parsed documents and the lines that follow from them; returns the lines."""
    group, plan = SILVER[layout.spec.source_id]
    stored = batch.put("bronze", bronze)
    count = stored.count()
    level = batch.store.level_for(count)
    # Where each task has many rows for each bucket it writes them itself: gathering whole buckets first would move every
    # row once more, documents and lines.
    in_place = count >= ROWS_IN_PLACE * stored.rdd.getNumPartitions() * batch.store.buckets_at(level)
    new = batch.put("documents", documents(stored, layout.spec).withColumn(INVOICE, group()), level, in_place=in_place)
    affected = new
    if batch.base.tables.get("documents"):
        # All versions of the invoices that the batch has documents of; only their buckets are read, and the batch's
        # own documents stay where they are.
        touched = new.select(F.col(INVOICE).alias("_touched"))
        history = batch.store.read("documents", batch.store.touched(touched), batch.base)
        # No hint: a batch of some hundred files is broadcast, a first load of everything is not.
        affected = history.join(touched, F.col(INVOICE).eqNullSafe(F.col("_touched")), "left_semi").unionByName(new)
    return batch.put("silver", plan(affected.drop(INVOICE)), level, check_keys=True, in_place=in_place)


def _put_portions(batch: Transaction, layout: Layout, bronze: DataFrame, began: int) -> None:
    """``_put_documents`` and its tests for portions that are told apart by ``inserted_at``, microseconds from ``began``.

    An invoice is derived once for each portion that has documents of it, from history and the portions up to there.
    Tests see each portion's lines, those that a later portion replaces included; the last ones are written. Anything that
    some portion might fail for by itself raises.
    """
    group, plan = SILVER[layout.spec.source_id]
    stored = batch.put("bronze", bronze)
    level = batch.store.level_for(stored.count())
    new = batch.put("documents", documents(stored, layout.spec).withColumn(INVOICE, group()), level)
    drawn = new.withColumn(PORTION, F.unix_micros("inserted_at") - F.lit(began))
    touched = drawn.groupBy(F.col(INVOICE).alias("_touched")).agg(F.collect_set(PORTION).alias("_portions"))
    affected = drawn
    if batch.base.tables.get("documents"):
        history = batch.store.read("documents", batch.store.touched(new.select(INVOICE)), batch.base)
        affected = history.withColumn(PORTION, F.lit(-1).cast("long")).unionByName(drawn)
    met = affected.join(touched, F.col(INVOICE).eqNullSafe(F.col("_touched")))
    later = F.filter("_portions", lambda p: p >= F.col(PORTION))
    met = met.withColumn(PORTION, F.explode(later)).drop(INVOICE, "_touched", "_portions")
    lines = staged(plan(met, within=(PORTION,)), "portions")
    try:
        _check_portions(batch, lines)
        # Keys that differ by portion: its tests compare no more than lines of one.
        test_batch(lines.withColumn(LINE_KEY, F.concat(PORTION, F.lit("|"), LINE_KEY)).drop(PORTION), layout.spec)
        last = F.max(PORTION).over(Window.partitionBy(LINE_KEY, F.when(F.col(LINE_KEY).isNull(), F.col(PORTION))))
        batch.put("silver", lines.withColumn("_last", last).filter(F.col(PORTION) == F.col("_last")), level)
    finally:
        discard(lines)


def _check_portions(batch: Transaction, lines: DataFrame) -> None:
    """Raise if a key that a portion has more than once is in the table or in an earlier portion."""
    keyed = lines.filter(F.col(LINE_KEY).isNotNull())
    digests = keyed.groupBy(PORTION, F.xxhash64(LINE_KEY)).agg(F.count(F.lit(1)).alias("n"))
    if (digests.agg(F.max("n")).first()[0] or 0) < 2:
        return
    repeated = keyed.groupBy(PORTION, LINE_KEY).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").groupBy(LINE_KEY).agg(F.max(PORTION).alias("_at"))
    earlier = keyed.join(repeated, LINE_KEY).filter(F.col(PORTION) < F.col("_at")).select(LINE_KEY)
    if batch.base.tables.get("silver"):
        known = batch.store.read("silver", batch.store.touched(repeated.select(LINE_KEY)), batch.base).select(LINE_KEY)
        earlier = earlier.unionByName(known.join(repeated, LINE_KEY, "left_semi"))
    conflict = earlier.limit(1).collect()
    if conflict:
        raise DuplicateKeyError(f"{LINE_KEY} = {conflict[0][0]!r} occurs more than once in a portion and before it")


def test_batch(lines: DataFrame, spec: SourceSpec) -> None:
    """Run the declared tests on a batch's lines and on the star they make by themselves.

    A batch replaces whole lines by key, and fact rows and dimension members follow from lines one by one: a line
    that breaks a test breaks it here too, and lines of earlier batches were tested then.
    """
    tables = {f"{SILVER_DB}.{spec.silver_table}": lines}
    gate(tables | {f"{GOLD_DB}.{name}": df for name, df in star({spec.source_id: lines}).items()})


test_batch.__test__ = False  # not a test of this repository


def load_bronze_batch(bronze: DataFrame, layout: Layout, number: list[int], stream: str = "rows", on_fail: str = "stop",
                      more: Callable[[Transaction, str | None], None] | None = None) -> str | None:
    """Add one batch of bronze rows and what follows from it, if its lines pass the data tests.

    A batch that fails adds nothing. With ``on_fail="continue"`` its rows are kept in quarantine, with ``"stop"`` the
    failure is raised; either way the batch counts as seen and is not taken again. ``more`` adds what else belongs to
    the batch and is told of the failure. A batch that the tables have is left out. Returns the failure.
    """
    if on_fail not in ("stop", "continue"):
        raise ValueError(f"on_fail must be 'stop' or 'continue', not {on_fail!r}")
    store = layout.store(bronze.sparkSession)
    batch = store.transaction()
    if is_loaded(batch.base.values, stream, number):
        return None
    failure = None
    try:
        test_batch(_put_documents(batch, layout, bronze), layout.spec)
    except (DataQualityError, DuplicateKeyError) as problem:
        failure = problem
        batch.drop()
        if on_fail == "continue":
            batch.put("quarantine", bronze.withColumn("reason", F.lit(str(problem))))
    if more:
        more(batch, None if failure is None else str(failure))
    _note_progress(batch, stream, number)
    batch.commit()
    store.compact()
    if failure is not None and on_fail == "stop":
        raise failure
    return None if failure is None else str(failure)


def load_files(files: DataFrame, layout: Layout, number: list[int], extractor: Callable[[], Extractor], on_fail: str = "stop",
               archive: str | None = None) -> None:
    """Extract some portions of files (path, portion), load what was read and note the state of each file.

    Portions are loaded in order, each as a batch of its own under ``number`` and its place: those that pass their tests
    together in one version, others in a version each. The extractor may be a costly model, so its results are written
    once and read for each use. A file without a result, or in a batch that stopped the source, stays in processing until
    ``requeue_stale`` puts it back. Files whose batch was loaded go to ``archive`` if one is given.
    """
    spark, stream = files.sparkSession, "files"
    if on_fail not in ("stop", "continue"):
        raise ValueError(f"on_fail must be 'stop' or 'continue', not {on_fail!r}")
    portions = sorted(r[0] for r in files.select(PORTION).distinct().collect())  # at most PORTIONS_TOGETHER
    values = layout.store(spark).version().values
    left = {p: [*number, place] for place, p in enumerate(portions) if not is_loaded(values, stream, [*number, place])}
    if not left:
        return
    files = files.filter(F.col(PORTION).isin(*left))
    _note_states(layout, with_file_name(files.select("path")), F.lit(STARTED))
    scratch = f"{layout.root}/extracted/{layout.spec.bucket}/{'-'.join(map(str, number))}"
    spread = files.select("path", PORTION).repartition(spark.sparkContext.defaultParallelism)  # a costly model gets all cores
    # A page of text is read but once: a file that is gone is told by its missing time.
    read = read_files(spread, PORTION)
    found = extract_documents(read, layout.spec, extractor, PORTION)
    gone = F.col("modificationTime").isNull()
    found = found.withColumns({
        "json": F.when(~gone, F.col("json")), "pages": F.when(~gone, F.col("pages")),
        "error": F.when(gone, F.lit("FileNotFoundError")).otherwise(F.col("error")).cast("string")})
    found.select(*EXTRACTED.names, PORTION).write.mode("overwrite").option("compression", "zstd").parquet(scratch)
    extracted = spark.read.schema(StructType([*EXTRACTED.fields, QUEUED[PORTION]])).parquet(scratch)

    def note(part: DataFrame) -> Callable[[Transaction, str | None], None]:
        def states(batch: Transaction, failure: str | None) -> None:
            rejected = quarantined(part)
            batch.put("rejected", rejected)
            held = QUARANTINED if on_fail == "continue" else STARTED
            state, outcome = (PROCESSED, "done") if failure is None else (held, f"failed_tests: {failure}")
            done = accepted(part).withColumn("outcome", F.lit(outcome))
            # Of files with one name the last portion's counts, as if each were noted by itself.
            both = latest_per_key(with_file_name(done.unionByName(rejected)), ["file"], [f"-{PORTION}"])
            batch.put("ledger", _states(both, layout, F.when(F.col("outcome") == outcome, state).otherwise(STARTED), F.col("outcome")))

        return states

    if len(left) > 1 and _load_together(extracted, layout, max(left.values()), stream, note(extracted)):
        if archive:
            _archive(spark, [r[0] for r in accepted(extracted).select("path").collect()], archive)
        delete_path(spark, scratch)
        return
    for portion, own in left.items():
        part = extracted.filter(F.col(PORTION) == portion)
        try:
            failure = load_bronze_batch(bronze_envelope(accepted(part), layout.spec), layout, own, stream, on_fail, note(part))
        except (DataQualityError, DuplicateKeyError):
            waiting = files.filter(F.col(PORTION) > portion)  # it stops the source before them
            if portion != portions[-1]:
                _note_states(layout, with_file_name(waiting.select("path")), F.lit(UNPROCESSED))
            raise
        if archive and failure is None:
            _archive(spark, [r[0] for r in accepted(part).select("path").collect()], archive)
    delete_path(spark, scratch)


def _load_together(extracted: DataFrame, layout: Layout, number: list[int], stream: str, more: Callable[[Transaction, str | None], None]) -> bool:
    """Add several portions in one version if each passes its tests; otherwise add nothing and return False."""
    store = layout.store(extracted.sparkSession)
    batch = store.transaction()
    began = time.time_ns() // 1000
    bronze = bronze_envelope(accepted(extracted), layout.spec, F.timestamp_micros(F.lit(began) + F.col(PORTION)))
    try:
        _put_portions(batch, layout, bronze, began)
    except (DataQualityError, DuplicateKeyError):
        batch.drop()
        return False
    more(batch, None)
    _note_progress(batch, stream, number)
    batch.commit()
    store.compact()
    return True


def _states(files: DataFrame, layout: Layout, state: Column, outcome: Column | None = None) -> DataFrame:
    return ledger_rows(files, layout.spec.source_id, state, F.current_timestamp(), outcome).dropDuplicates(["file"])


def _note_states(layout: Layout, files: DataFrame, state: Column) -> None:
    batch = layout.store(files.sparkSession).transaction()
    batch.put("ledger", _states(files, layout, state))
    batch.commit()


def _archive(spark: SparkSession, paths: list[str], folder: str) -> None:
    """Move the files of a portion out of the inbox. One whose move is cut short is seen and not taken again."""
    system = spark._jvm.org.apache.hadoop.fs.Path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(spark._jvm.org.apache.hadoop.fs.Path(folder))
    for path in paths:
        name = path.rsplit("/", 1)[-1]
        if path_exists(spark, f"{folder}/{name}"):
            name = f"{hashlib.sha256(path.encode()).hexdigest()[:16]}-{name}"
        system.rename(spark._jvm.org.apache.hadoop.fs.Path(path), spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}"))


def find_new_files(spark: SparkSession, layout: Layout, folder: str) -> DataFrame:
    """path, modificationTime, length and version of the files that no earlier run has taken up."""
    listed = list_files(spark, folder)
    store = layout.store(spark)
    version = store.version()
    if not version.tables.get("seen"):
        return not_seen(listed, spark.createDataFrame([], SEEN))
    versions = not_seen(listed, spark.createDataFrame([], SEEN)).select("version")
    return not_seen(listed, store.read("seen", store.touched(versions), version))


def open_run(spark: SparkSession, layout: Layout, files: DataFrame, max_files: int) -> int:
    """Write ``files`` as the portions of a new run and note them as seen; returns how many there are."""
    files = staged(files.select(*SEEN.names), "new-files")
    count = files.count()
    if not count:
        return 0
    files = in_portions(files, max_files) if count > max_files else files.withColumn("portion", F.lit(0))
    store = layout.store(spark)
    batch = store.transaction()
    number = batch.values.get("run", {"number": 0})["number"] + 1
    queue = f"{layout.root}/queue/{layout.spec.bucket}/run={number}-{batch.base.number}"
    files.select(*QUEUED.names).repartition(-(-count // max_files), "portion").write.partitionBy("portion").parquet(f"{queue}/files")
    batch.put("seen", files.select(*SEEN.names), store.level_for(count))
    batch.put("ledger", _states(with_file_name(files.select("path")), layout, F.lit(UNPROCESSED)), store.level_for(count))
    batch.values["run"] = {"number": number, "queue": queue}
    batch.commit()
    return count


def close_run(spark: SparkSession, layout: Layout) -> None:
    """Forget a run whose portions are all loaded."""
    batch = layout.store(spark).transaction()
    run = batch.values.get("run", {})
    if "queue" in run:
        batch.values["run"] = {"number": run["number"]}
        batch.commit()
        delete_path(spark, run["queue"])


def run_stream(spark: SparkSession, layout: Layout, extractor: Callable[[], Extractor], on_fail: str = "stop", archive: str | None = None) -> StreamingQuery:
    """Take the portions of the open run that are not loaded yet, some at a time, and stop.

    A batch that is cut short runs again at the next start, under the same number and with the same files; one that
    is part of the tables already is left out.
    """
    run = layout.store(spark).version().values.get("run", {"number": 0})
    queue = run.get("queue", f"{layout.root}/queue/{layout.spec.bucket}/none")
    for name in ("files", "checkpoint"):
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{queue}/{name}")
        path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(path)
    portions = spark.readStream.schema(QUEUED).option("maxFilesPerTrigger", PORTIONS_TOGETHER).parquet(f"{queue}/files")
    return (
        portions.writeStream
        .foreachBatch(lambda files, batch_id: load_files(files, layout, [run["number"], batch_id], extractor, on_fail, archive))
        .option("checkpointLocation", f"{queue}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )


def ingest_stream(
    spark: SparkSession,
    spec: SourceSpec,
    in_dir: str,
    out_dir: str,
    extractor: Callable[[], Extractor],
    max_files: int = MAX_FILES_PER_BATCH,
    archive: str | None = None,
    buckets: int = 256,
    on_fail: str = "stop",
) -> StreamingQuery:
    """Process all new files of a source and stop; the next call takes up what came since.

    A run that an earlier call left open, for it failed or its process ended, is finished first.
    """
    layout = Layout(out_dir, spec, buckets)
    if "queue" in layout.store(spark).version().values.get("run", {}):
        run_stream(spark, layout, extractor, on_fail, archive).awaitTermination()
        close_run(spark, layout)
    open_run(spark, layout, find_new_files(spark, layout, in_dir), max_files)
    return run_stream(spark, layout, extractor, on_fail, archive)


def upsert_stream(bronze: DataFrame, spec: SourceSpec, out_dir: str, checkpoint: str, buckets: int = 256, on_fail: str = "stop") -> StreamingQuery:
    """The same load for a stream of bronze rows that were extracted elsewhere."""
    layout = Layout(out_dir, spec, buckets)
    stream = f"rows-{hashlib.sha256(checkpoint.encode()).hexdigest()[:16]}"
    return (
        bronze.writeStream.foreachBatch(lambda rows, batch_id: load_bronze_batch(rows, layout, [batch_id], stream, on_fail))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _table(spark: SparkSession, root: str, spec: SourceSpec, table: str) -> DataFrame | None:
    store = Layout(root, spec).store(spark)
    version = store.version()
    return store.read(table, at=version) if version.number else None


def silver_table(spark: SparkSession, root: str, spec: SourceSpec) -> DataFrame | None:
    return _table(spark, root, spec, "silver")


def bronze_table(spark: SparkSession, root: str, spec: SourceSpec) -> DataFrame | None:
    return _table(spark, root, spec, "bronze")


def file_states(spark: SparkSession, root: str, spec: SourceSpec) -> DataFrame | None:
    return _table(spark, root, spec, "ledger")


def rejected_files(spark: SparkSession, root: str, spec: SourceSpec) -> DataFrame | None:
    return _table(spark, root, spec, "rejected")


def quarantined_rows(spark: SparkSession, root: str, spec: SourceSpec) -> DataFrame | None:
    return _table(spark, root, spec, "quarantine")
