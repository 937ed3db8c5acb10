"""Session defaults and the shared folder for durable intermediate tables."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# Everything else is left to Spark's defaults and to AQE; shuffle partitions and file split
# sizes belong to the cluster's own configuration.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Documents are large: keep the batches handed to Python workers small.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "512",
    "spark.sql.execution.arrow.maxBytesPerBatch": "64MB",
}

FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(app_name: str = "tallyspark", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ship(spark: SparkSession, *packages: Path) -> None:
    """Make Python packages importable on executors, for jobs not submitted with ``--py-files``."""
    already = getattr(spark.sparkContext, "_tallyspark_shipped", set())
    for package in set(packages) - already:
        archive = Path(tempfile.mkdtemp(prefix="tallyspark-code-")) / f"{package.name}.zip"
        with zipfile.ZipFile(archive, "w") as z:
            for file in sorted(package.rglob("*.py")):
                z.write(file, file.relative_to(package.parent))
        spark.sparkContext.addPyFile(str(archive))
    spark.sparkContext._tallyspark_shipped = already | set(packages)


def durable_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Where the setting is absent a folder of our own is used, but only in local mode: a
    machine-local folder on a cluster would be lost with its machine.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or getattr(context, "_tallyspark_root", None)
    if root:
        return root.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    context._tallyspark_root = tempfile.mkdtemp(prefix="tallyspark-")  # the setting itself can't be changed any more
    return context._tallyspark_root


def durable_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no other run uses."""
    return f"{durable_root(spark)}/tallyspark/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


@contextlib.contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Delete the shuffle files of every execution within as it ends; else they stay until the driver collects its garbage."""
    before = spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.unset(FREE_SHUFFLES) if before is None else spark.conf.set(FREE_SHUFFLES, before)


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and read it back.

    Used where a plan scans the same derived rows several times: the later scans are then
    columnar and pruned, and the lineage before them is cut by a table that outlives executors.
    Hashes and long texts make most of it, which zstd stores in far less room than the default.
    What was shuffled for the table is deleted as soon as it is written: nothing reads that again.
    """
    path = durable_path(df.sparkSession, name)
    with shuffles_freed(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table._staged_path = path
    return table


def are_small(table: DataFrame, *tables: DataFrame, limit: int) -> bool:
    """Whether tables that :func:`staged` returned have at most ``limit`` bytes together."""
    return sum(_bytes(t.sparkSession, t._staged_path) for t in (table, *tables)) <= limit


def discard(*tables: DataFrame) -> None:
    """Delete tables that :func:`staged` returned, once nothing that is still to be computed reads them."""
    for table in tables:
        _delete(table.sparkSession, table._staged_path)


def clear_staged(spark: SparkSession) -> None:
    """Delete what this application has staged, once the results that read it are written."""
    _delete(spark, f"{durable_root(spark)}/tallyspark/{spark.sparkContext.applicationId}")


def _bytes(spark: SparkSession, path: str) -> int:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(folder).getLength()


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
