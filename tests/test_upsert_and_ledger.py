import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyspark.operators import DuplicateKeyError, read_table, upsert, upsert_table
from tallyspark.schemas import LEDGER, columns
from tallyspark.sources import ledger

SCHEMA = "k string, v int"
TABLE = columns(SCHEMA)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_upsert(spark):
    target = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], SCHEMA)
    source = spark.createDataFrame([("b", 20), ("c", 30), (None, 40)], SCHEMA)
    merged = upsert(target, source, "k")
    assert rows(merged) == [("a", 1), ("b", 20), ("c", 30), (None, 3), (None, 40)]
    assert rows(upsert(None, source, "k")) == rows(source)


def test_repeated_source_keys(spark):
    target = spark.createDataFrame([("a", 1)], SCHEMA)
    with pytest.raises(Exception, match="DuplicateKeyError: k = a occurs more than once"):
        upsert(target, spark.createDataFrame([("a", 2), ("a", 3)], SCHEMA), "k").collect()
    new = spark.createDataFrame([("b", 2), ("b", 3)], SCHEMA)
    assert rows(upsert(target, new, "k")) == [("a", 1), ("b", 2), ("b", 3)]


def test_upsert_scans_each_side_once(spark, tmp_path):
    for name in ("target", "source"):
        spark.range(10).select(F.col("id").cast("string").alias("k"), F.lit(1).alias("v")).write.parquet(str(tmp_path / name))
    sides = [spark.read.parquet(str(tmp_path / name)) for name in ("target", "source")]
    plan = upsert(*sides, "k")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parquet") == 2 and "Join" not in plan


def test_upsert_table_appends_batches(spark, tmp_path):
    path = str(tmp_path / "t")
    assert read_table(spark, path, TABLE) is None
    upsert_table(spark, path, spark.range(200).select(F.col("id").cast("string").alias("k"), F.lit(1).alias("v")), "k", 16)
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "t").glob("data/*/*/bucket=*/*.parquet")}
    assert before
    batch = spark.createDataFrame([("7", 2), ("new", 3)], SCHEMA)
    for _ in range(2):  # the second time changes nothing
        upsert_table(spark, path, batch, "k", 16)
        table = read_table(spark, path, TABLE)
        assert table.columns == ["k", "v"] and table.count() == 201
        assert rows(table.filter("v > 1")) == [("7", 2), ("new", 3)]
    assert {p: p.stat().st_mtime_ns for p in before} == before
    with pytest.raises(DuplicateKeyError):
        upsert_table(spark, path, spark.createDataFrame([("7", 2), ("7", 3)], SCHEMA), "k", 16)
    assert read_table(spark, path, TABLE).count() == 201


NOW = dt.datetime(2024, 1, 1, 12)


def entry(file, state, age_minutes):
    return (1, file, state, NOW - dt.timedelta(minutes=age_minutes), None)


def test_requeue_stale(spark):
    table = spark.createDataFrame([
        entry("old.pdf", "startedprocessing", 61), entry("hour.pdf", "startedprocessing", 60),
        entry("old.PDF", "startedprocessing", 90), entry("done.pdf", "processed", 90), entry("new.pdf", "unprocessed", 90),
    ], LEDGER)
    got = {r.file: r.state for r in ledger.requeue_stale(table, F.lit(NOW)).collect()}
    assert got == {"old.pdf": "unprocessed", "hour.pdf": "startedprocessing", "old.PDF": "startedprocessing",
                   "done.pdf": "processed", "new.pdf": "unprocessed"}


def test_ledger_moves(spark):
    files = spark.createDataFrame([("a.pdf",), ("b.pdf",)], "file string")
    start = ledger.move(None, ledger.ledger_rows(files, 1, F.lit(ledger.STARTED), F.lit(NOW)))
    end = ledger.move(start, ledger.ledger_rows(files.limit(1), 1, F.lit(ledger.PROCESSED), F.lit(NOW), F.lit("done")))
    assert sorted((r.file, r.state, r.outcome) for r in end.collect()) == [
        ("a.pdf", "processed", "done"), ("b.pdf", "startedprocessing", None)]
