"""Finding and reading new document files."""

from __future__ import annotations

import os
from collections.abc import Iterator
from datetime import UTC, datetime
from urllib.parse import unquote, urlsplit

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.functions.scalars import file_name, has_document_suffix
from tallyspark.schemas import LISTED
from tallyspark.session import staged

MAX_FILES_PER_BATCH = 500  # fixed value
LISTED_TOGETHER = 10_000
READ_TOGETHER = 16 << 20  # bytes
# Object stores that Spark names otherwise than Arrow does.
ARROW_SCHEMES = {"s3a": "s3", "s3n": "s3"}


def entries(folder: str) -> Iterator[tuple[bool, str, datetime | None, int | None]]:
    """Whether it is a folder, path, time and size of everything in one folder, not below it. Runs in a task."""
    parts = urlsplit(folder)
    if parts.scheme in ("", "file"):
        base = unquote(parts.path) if parts.scheme else folder
        with os.scandir(base) as found:
            for entry in found:
                if entry.is_dir():
                    yield True, f"{folder.rstrip('/')}/{entry.name}", None, None
                else:
                    about = entry.stat()
                    yield False, f"{folder.rstrip('/')}/{entry.name}", datetime.fromtimestamp(about.st_mtime_ns // 1_000_000 / 1000, UTC), about.st_size
        return
    from pyarrow import fs

    system, base = fs.FileSystem.from_uri(folder.replace(f"{parts.scheme}://", f"{ARROW_SCHEMES.get(parts.scheme, parts.scheme)}://", 1))
    for info in system.get_file_info(fs.FileSelector(base)):
        path = f"{folder.rstrip('/')}/{info.base_name}"
        yield (True, path, None, None) if info.type == fs.FileType.Directory else (False, path, info.mtime, info.size)


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """path, modificationTime and length of all documents below ``folder``, listed in tasks, one for each folder.

    The driver knows how deep the folders are and nothing else of them. Suffixes are matched exactly, in lower case;
    names that begin with ``.`` or ``_`` are left out, as Spark leaves them out.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["is_folder", *LISTED.names]
        for batch in batches:
            for folder in batch.column("path").to_pylist():
                held = []
                for row in entries(folder):
                    if not row[1].rsplit("/", 1)[-1].startswith((".", "_")):
                        held.append(row)
                    if len(held) == LISTED_TOGETHER:
                        yield _batch(held, names)
                        held = []
                yield _batch(held, names)

    levels = []
    folders = spark.createDataFrame([(folder,)], "path string")
    while True:
        found = staged(folders.mapInArrow(run, "is_folder boolean, path string, modificationTime timestamp, length bigint"), "listing")
        levels.append(found.filter("NOT is_folder"))
        below = found.filter("is_folder").select("path")
        count = below.count()
        if not count:
            break
        folders = below.repartition(min(count, 10_000))
    listed = levels[0]
    for level in levels[1:]:
        listed = listed.unionByName(level)
    return listed.filter(has_document_suffix(F.col("path"))).select(*LISTED.names)


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = [pa.bool_(), pa.string(), pa.timestamp("us", "UTC"), pa.int64()]
    columns = list(zip(*rows, strict=True)) if rows else [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def file_version() -> Column:
    """What a file counts as new by: its path and its time, so one put in again under its name is new."""
    return F.concat_ws("|", F.col("path"), F.unix_millis("modificationTime").cast("string"))


def not_seen(listed: DataFrame, seen: DataFrame) -> DataFrame:
    """Listed files that ``seen`` (version) does not have, with their version, however old they are."""
    return listed.withColumn("version", file_version()).join(seen.select("version"), "version", "left_anti")


def in_portions(files: DataFrame, size: int) -> DataFrame:
    """``files`` (path, ...) with the column ``portion``: numbers from 0, ``size`` files each, in the order of paths.

    One sort; then places are counted on from the sizes of its partitions.
    """
    ordered = staged(files.orderBy("path").withColumn("_place", F.monotonically_increasing_id()), "ordered-files")
    part = F.shiftright("_place", 33)
    sizes = [(r[0], r[1]) for r in ordered.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).orderBy("part").collect()]  # one per partition of the sort
    before, at = [], 0
    for number, n in sizes:
        before.append((number, at))
        at += n
    starts = files.sparkSession.createDataFrame(before, "_part long, _before long")
    place = F.col("_before") + F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    return ordered.join(F.broadcast(starts), part == F.col("_part")).withColumn("portion", F.floor(place / size).cast("int")).drop("_place", "_part", "_before")


def _local(path: str) -> str | None:
    """The name of a file on this machine, None for a path in another store."""
    if path.startswith("file:"):
        return "/" + path.removeprefix("file:").lstrip("/")
    return None if "://" in path else path


def _content(path: str) -> tuple[str, datetime | None, bytes | None]:
    """Path as Spark writes it, time and content of one file; no content if it isn't there. Runs in a task."""
    local = _local(path)
    if local is not None:
        try:
            with open(local, "rb") as file:
                return f"file:{local}", datetime.fromtimestamp(os.fstat(file.fileno()).st_mtime_ns // 1_000_000 / 1000, UTC), file.read()
        except (FileNotFoundError, NotADirectoryError):
            return path, None, None
    from pyarrow import fs

    scheme, rest = path.split("://", 1)
    system, _ = fs.FileSystem.from_uri(f"{ARROW_SCHEMES.get(scheme, scheme)}://{rest.split('/', 1)[0]}")
    base = rest if scheme in ("s3a", "s3n", "s3", "gs") else "/" + rest.split("/", 1)[-1]
    info = system.get_file_info(base)
    if info.type == fs.FileType.NotFound:
        return path, None, None
    with system.open_input_stream(base) as file:
        return path, info.mtime, file.read()


def read_files(paths: DataFrame, *kept: str) -> DataFrame:
    """path, modificationTime and content of files by their ``path``, opened in tasks; one that is gone has no content.

    The driver neither looks files up nor lists them, so a file costs it nothing. Batches hold some 16 MB. Columns
    named in ``kept`` stay with their file.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = ["path", "modificationTime", "content", *kept]
            kinds = [pa.string(), pa.timestamp("us", "UTC"), pa.binary(), *(batch.schema.field(n).type for n in kept)]
            held, size = [], 0
            for path, *others in zip(*(batch.column(n).to_pylist() for n in ("path", *kept)), strict=True):
                held.append((*_content(path), *others))
                size += len(held[-1][2] or b"")
                if size >= READ_TOGETHER:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held, strict=True), kinds, strict=True)], names)
                    held, size = [], 0
            if held:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held, strict=True), kinds, strict=True)], names)

    types = "".join(f", {n} {paths.schema[n].dataType.simpleString()}" for n in kept)
    return paths.select("path", *kept).mapInArrow(run, f"path string, modificationTime timestamp, content binary{types}")


def with_file_name(files: DataFrame) -> DataFrame:
    return files.withColumn("file", file_name(F.col("path")))
