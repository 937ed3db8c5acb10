import time
from pathlib import Path

import pytest

from tallyspark import session
from tallyspark.session import clear_staged, discard, staged
from tallyspark.sources.export import to_columns


def test_staged_tables_can_be_cleared(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(session, "durable_root", lambda spark: f"file://{tmp_path}")
    assert staged(spark.range(3), "numbers").count() == 3
    folder = tmp_path / "tallyspark" / spark.sparkContext.applicationId
    assert folder.exists()
    clear_staged(spark)
    assert not Path(folder).exists()


def test_staged_tables_leave_no_shuffle_files(spark):
    def files():
        found = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {found.apply(k).getName() for k in range(found.size()) if found.apply(k).getName().startswith("shuffle_")}

    before = files()
    table = staged(spark.range(1000).selectExpr("id % 7 AS k").groupBy("k").count(), "counts")
    waited = time.time() + 10
    while files() - before and time.time() < waited:
        time.sleep(0.1)
    assert not files() - before
    assert spark.conf.get(session.FREE_SHUFFLES) == "false" and table.count() == 7


def test_staged_tables_can_be_discarded(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(session, "durable_root", lambda spark: f"file://{tmp_path}")
    first, second = staged(spark.range(3), "one"), staged(spark.range(4), "two")
    discard(first)
    assert [p.name[:3] for p in tmp_path.glob("tallyspark/*/*")] == ["two"] and second.count() == 4


def test_large_results_are_refused(spark):
    assert to_columns(spark.range(5), max_rows=5).num_rows == 5
    with pytest.raises(ValueError, match="more than 4"):
        to_columns(spark.range(5), max_rows=4)
