"""Pages as files: those that share a URL, and reading them."""

from __future__ import annotations

from tallyspark.sources.files import read_files
from workload import file_queries


def test_pages_that_share_a_url_are_counted_once_each(spark, tmp_path):
    page = "<html lang=\"en\"><body>x</body>"
    rows = [(1, "http://a/1", page + "</html>"), (2, "http://a/1", page + "</html>"), (3, "http://a/1", page)]
    spark.createDataFrame(rows, "page_id bigint, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    counted = {(r.kept, r.lang): r.n for r in file_queries.extract_quarantine(spark, str(tmp_path)).collect()}
    assert counted == {(True, "en"): 2, (False, "en"): 1}


def test_files_are_read_in_tasks_and_missing_ones_have_no_content(spark, tmp_path):
    (tmp_path / "a*{1}.pdf").write_bytes(b"one")
    (tmp_path / "b.pdf").write_bytes(b"")
    paths = [f"{tmp_path}/a*{{1}}.pdf", f"file://{tmp_path}/b.pdf", f"{tmp_path}/gone.pdf"]
    read = read_files(spark.createDataFrame([(p,) for p in paths], "path string"))
    rows = {r.path: r for r in read.collect()}
    there = spark.read.format("binaryFile").load(str(tmp_path)).select("path", "modificationTime", "content").collect()
    assert len(rows) == 3 and all(rows[r.path][:] == r[:] for r in there)
    gone = rows[f"{tmp_path}/gone.pdf"]
    assert gone.content is None and gone.modificationTime is None
