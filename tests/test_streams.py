import datetime as dt
import json
import sys
import uuid
from functools import partial

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from tallyspark.operators.extract import HtmlColumns, accepted, extract_documents, quarantined
from tallyspark.schemas import BRONZE
from tallyspark.sources.bronze import bronze_envelope
from tallyspark.sources.registry import DS1, DS2
from tallyspark.sources.files import in_portions, list_files
from tallyspark.streaming.ingest import (
    Layout, bronze_table, file_states, find_new_files, ingest_stream, load_files, open_run, quarantined_rows, rejected_files, silver_table,
)
from tallyspark.streaming.runs import Run, run_all

# Workers cannot import this test module, so its classes travel with the job.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class LabelReader:
    """Files hold their labels as JSON; ``fail`` in one refuses it, as long as the marker is there."""

    def __init__(self, marker=None):
        self.marker = marker

    def extract(self, content):
        from pathlib import Path

        labels = json.loads(bytes(content))
        if labels.pop("fail", False) and (self.marker is None or Path(self.marker).exists()):
            raise ValueError("unreadable")
        return None if labels.get("empty") else labels

    def close(self):
        pass


def invoice(order, item="pen", qty="2", **extra):
    return {"header": {"Bill To": "C", "Address": "A", "Date": "2024-01-02"},
            "items": [{"Item": item, "Quantity": qty, "Rate": "$1,000.50"}], "summary": {"order": order}, **extra}


def put(folder, name, labels):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(json.dumps(labels))


def lines(spark, root):
    return sorted((r.order_id, r.item_desc, r.item_qty, r.item_rate) for r in silver_table(spark, str(root), DS2).collect())


def test_ingest_takes_each_file_once(spark, tmp_path):
    inbox, out = tmp_path / "in", tmp_path / "out"

    def run():
        ingest_stream(spark, DS2, str(inbox), str(out), LabelReader, max_files=2, buckets=4).awaitTermination()

    put(inbox, "1.pdf", invoice("O1"))
    put(inbox, "2.jpg", invoice("O2"))
    put(inbox, "3.png", invoice("O3", fail=True))
    put(inbox, "4.PDF", invoice("O4"))
    put(inbox, "5.jpeg", {"empty": True})
    run()
    assert lines(spark, out) == [("O1", "pen", 2, 1000.5), ("O2", "pen", 2, 1000.5)]
    assert {(r.error, r.outcome) for r in rejected_files(spark, str(out), DS2).collect()} == {
        ("ValueError: unreadable", "failed_retryable"), (None, "failed_retryable")}
    run()
    assert len(lines(spark, out)) == 2
    put(inbox, "6.pdf", invoice("O1", qty="9"))  # same line again: replaced
    put(inbox, "7.pdf", invoice("O2", item="ink"))  # another line of a known order: added
    run()
    assert lines(spark, out) == [("O1", "pen", 9, 1000.5), ("O2", "ink", 2, 1000.5), ("O2", "pen", 2, 1000.5)]


def test_first_batch_without_any_result(spark, tmp_path):
    put(tmp_path / "in", "1.pdf", invoice("O1", fail=True))
    run = Run(spark, str(tmp_path / "root"), {2: str(tmp_path / "in")}, {2: LabelReader},
              database=f"gold_{uuid.uuid4().hex[:8]}", buckets=4)
    assert [tuple(r) for r in run_all(run, "1").collect()] == [(2, "done", 0, 1, None)]
    assert lines(spark, tmp_path / "root") == [] and spark.table(f"{run.database}.fact_invoice_line").count() == 0


def test_consumed_files_are_archived(spark, tmp_path):
    inbox = tmp_path / "in"
    for i in range(3):  # Spark moves files away while it plans a later batch
        put(inbox, f"{i}.pdf", invoice(f"O{i}"))
        ingest_stream(spark, DS2, str(inbox), str(tmp_path / "out"), LabelReader,
                      archive=str(tmp_path / "archive"), buckets=4).awaitTermination()
    assert len(lines(spark, tmp_path / "out")) == 3
    assert {p.name for p in (tmp_path / "archive").rglob("*.pdf")} >= {"0.pdf"}


def test_run_reports_retries_and_publishes_only_tested_tables(spark, tmp_path):
    inbox, marker = tmp_path / "in", tmp_path / "broken"
    marker.touch()
    put(inbox, "1.pdf", invoice("O1"))
    put(inbox, "2.pdf", invoice("O2", fail=True))
    run = Run(spark, str(tmp_path / "root"), {2: str(inbox)}, {2: partial(LabelReader, str(marker))},
              database=f"gold_{uuid.uuid4().hex[:8]}", buckets=4)
    assert [tuple(r) for r in run_all(run, "1").collect()] == [(2, "done", 1, 1, None)]
    fact = f"{run.database}.fact_invoice_line"
    assert [r.invoice_no for r in spark.table(fact).collect()] == ["O1"]

    now = F.current_timestamp()
    assert run.retry_stale(2, now) == 0
    marker.unlink()
    assert run.retry_stale(2, now + F.expr("INTERVAL 2 HOURS")) == 1
    assert [tuple(r) for r in run_all(run, "2").collect()] == [(2, "done", 2, 0, None)]
    assert sorted(r.invoice_no for r in spark.table(fact).collect()) == ["O1", "O2"]

    put(inbox, "3.pdf", invoice("O3", qty="0"))  # breaks a data test
    outcome = run_all(run, "3").first()
    assert outcome.status == "failed" and "positive_qty" in outcome.problem
    assert sorted(r.invoice_no for r in spark.table(fact).collect()) == ["O1", "O2"]


def ds1_invoice(number, qty="1"):
    return {"header": {"Invoice no": number, "Invoice date": "2024-01-02", "Seller": "S", "Buyer": "B", "Seller tax id": "s", "Client tax id": "c"},
            "items": [{"Description": "pen", "Quantity": qty, "Price": "2.5"}], "summary": {}}


def test_gate_of_one_source_leaves_the_other(spark, tmp_path):
    """Source 2 breaks a test: source 1 is published, source 2 as it was. Then a fault gets past the load."""
    root, folders = str(tmp_path / "root"), {1: str(tmp_path / "in1"), 2: str(tmp_path / "in2")}
    run = Run(spark, root, folders, {1: LabelReader, 2: LabelReader}, database=f"gold_{uuid.uuid4().hex[:8]}", buckets=4)
    fact = f"{run.database}.fact_invoice_line"
    put(tmp_path / "in1", "1.jpg", ds1_invoice("A1"))
    put(tmp_path / "in2", "1.pdf", invoice("O1"))
    assert [r.status for r in run_all(run, "1").collect()] == ["done", "done"]
    put(tmp_path / "in1", "2.jpg", ds1_invoice("A2"))
    put(tmp_path / "in2", "2.pdf", invoice("O2", qty="0"))
    outcomes = run_all(run, "2").collect()
    assert [(r.status, r.processed) for r in outcomes] == [("done", 2), ("failed", 1)] and "positive_qty" in outcomes[1].problem
    assert sorted(r.invoice_no for r in spark.table(fact).collect()) == ["A1", "A2", "O1"]
    states = {r.file: (r.state, r.outcome) for r in file_states(spark, root, DS2).collect()}
    assert states["1.pdf"] == ("processed", "done") and states["2.pdf"][0] == "startedprocessing" and "positive_qty" in states["2.pdf"][1]

    batch = run.layout(2).store(spark).transaction()  # a line that no test has seen
    bad = silver_table(spark, root, DS2).withColumn("item_qty", F.lit(-1).cast("bigint")).withColumn("unique_invoice_line_no", F.lit("x"))
    batch.put("silver", bad)
    batch.commit()
    run.problems.clear()
    run.publish("3")
    assert list(run.problems) == [2] and sorted(r.invoice_no for r in spark.table(fact).collect()) == ["A1", "A2", "O1"]


def test_bad_batch_goes_to_quarantine_and_the_next_is_loaded(spark, tmp_path):
    root = str(tmp_path / "root")
    for n, qty in enumerate(["1", "0", "3"], 1):
        put(tmp_path / "in", f"{n}.pdf", invoice(f"O{n}", qty=qty))
    run = Run(spark, root, {2: str(tmp_path / "in")}, {2: LabelReader}, max_files=1, buckets=4, on_fail="continue", archives={2: str(tmp_path / "old")})
    run.ingest()
    assert run.problems == {} and [r[0] for r in lines(spark, root)] == ["O1", "O3"]
    states = {r.file: r.state for r in file_states(spark, root, DS2).collect()}
    assert states == {"1.pdf": "processed", "2.pdf": "quarantined", "3.pdf": "processed"}
    assert [(r.file_name_in_R2, "positive_qty" in r.reason) for r in quarantined_rows(spark, root, DS2).collect()] == [("2.pdf", True)]
    assert sorted(p.name for p in (tmp_path / "old").iterdir() if p.suffix == ".pdf") == ["1.pdf", "3.pdf"]
    assert not (tmp_path / "root" / "queue" / "ds2" / "run=1-0").exists()


def test_run_that_was_cut_short_goes_on(spark, tmp_path, monkeypatch):
    """The process ends after one batch is part of the tables and before its checkpoint is: nothing is loaded twice."""
    layout = Layout(str(tmp_path / "root"), DS2, 4)
    for n in (1, 2):
        put(tmp_path / "in", f"{n}.pdf", invoice(f"O{n}"))
    assert open_run(spark, layout, find_new_files(spark, layout, str(tmp_path / "in")), 1) == 2
    assert find_new_files(spark, layout, str(tmp_path / "in")).count() == 0
    queued = spark.read.parquet(layout.store(spark).version().values["run"]["queue"] + "/files").filter("portion = 0")
    load_files(queued, layout, [1, 0], LabelReader)
    ingest_stream(spark, DS2, str(tmp_path / "in"), str(tmp_path / "root"), LabelReader, buckets=4).awaitTermination()
    assert bronze_table(spark, layout.root, DS2).count() == len({r[0] for r in lines(spark, layout.root)}) >= 1
    assert "queue" not in layout.store(spark).version().values["run"]


def test_listing(spark, tmp_path):
    for name in ("a.pdf", "b/c.jpg", "b/d/e.png", "b/.x.pdf", "_tmp/y.pdf", "f.PDF", "g.txt", "h [1].pdf"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text(name)
    listed = list_files(spark, str(tmp_path))
    assert sorted((r.path.removeprefix(f"{tmp_path}/"), r.length) for r in listed.collect()) == [
        ("a.pdf", 5), ("b/c.jpg", 7), ("b/d/e.png", 9), ("h [1].pdf", 9)]
    read = {r.path.rsplit("/", 1)[-1]: r.modificationTime for r in spark.read.format("binaryFile").load(str(tmp_path / "*.pdf")).collect()}
    assert {r.path.rsplit("/", 1)[-1]: r.modificationTime for r in listed.filter("path NOT LIKE '%/b/%'").collect()} == {
        k.replace("%20", " "): v for k, v in read.items()}
    portions = in_portions(spark.range(25).select(F.format_string("%03d", "id").alias("path")).repartition(5), 10)
    assert sorted((r.portion, r.path) for r in portions.collect()) == [(n // 10, f"{n:03d}") for n in range(25)]


def test_failing_source_does_not_stop_the_next(spark, tmp_path):
    put(tmp_path / "in", "1.pdf", invoice("O1"))

    class Broken(LabelReader):
        def __init__(self):
            raise OSError("model missing")

    run = Run(spark, str(tmp_path / "root"), {1: str(tmp_path / "in"), 2: str(tmp_path / "in")},
              {1: Broken, 2: LabelReader}, database=f"gold_{uuid.uuid4().hex[:8]}", buckets=4)
    first, second = run_all(run, "1").collect()
    assert (first.status, second.status, second.processed) == ("failed", "done", 1) and "model missing" in first.problem


def test_unregistered_folder_stops_the_run(spark, tmp_path):
    with pytest.raises(ValueError):
        Run(spark, str(tmp_path), {9: str(tmp_path)}, {}).ingest()


def test_extraction_isolates_errors_and_ids_are_repeatable(spark):
    when = dt.datetime(2024, 1, 1)
    files = spark.createDataFrame(
        [(f"in/{i}.pdf", when, bytearray(json.dumps(d).encode())) for i, d in enumerate(
            [invoice("O1"), invoice("O2", fail=True), {"empty": True}])],
        "path string, modificationTime timestamp, content binary")
    extracted = extract_documents(files, DS2, LabelReader)
    assert accepted(extracted).count() == 1 and quarantined(extracted).count() == 2
    rows = bronze_envelope(accepted(extracted), DS2)
    assert rows.columns == BRONZE.names
    assert rows.first().id == rows.first().id and rows.first().file_name_in_R2 == "0.pdf"
    nested = extract_documents(files.limit(1), DS1, LabelReader).first().json
    assert list(json.loads(nested)) == ["gt_parse"]


class PageReader(LabelReader):
    """Three pages, of which the first has no data."""

    def extract(self, content):
        labels = super().extract(content)
        return [{"extracted_data": None, "raw_text": 'First "page"'}, {"extracted_data": labels, "raw_text": "2"}, {"extracted_data": None, "raw_text": None}]


def test_first_of_several_pages_is_loaded(spark, tmp_path):
    put(tmp_path / "in", "1.pdf", invoice("O1"))
    ingest_stream(spark, DS2, str(tmp_path / "in"), str(tmp_path / "out"), PageReader, buckets=4).awaitTermination()
    assert [r.raw_json for r in bronze_table(spark, str(tmp_path / "out"), DS2).collect()] == [json.dumps('First "page"')]
    assert lines(spark, tmp_path / "out") == []  # no path resolves in a text
    files = spark.createDataFrame([("p", dt.datetime(2024, 1, 1), bytearray(json.dumps(invoice("O1")).encode()))],
                                  "path string, modificationTime timestamp, content binary")
    pages = extract_documents(files, DS2, PageReader).first().pages
    assert [(json.loads(p.extracted_data)["summary"]["order_id"] if p.extracted_data else None, p.raw_text) for p in pages] == [
        (None, 'First "page"'), ("O1", "2"), (None, None)]


def test_column_extractor_needs_no_python(spark):
    labels = {"header": {"Bill To": "<b>([^<]*)</b>", "Customer Name": "<i>([^<]*)</i>", "Date": "on ([0-9-]+)"}, "items": {"Item": "<p>([^<]*)</p>"}, "summary": {}}
    html = ["<b></b><i>late</i><p>\"é\" \\</p></html>", "<i>second</i> on 2024-01-02</html>", "<b>cut", "</html>"]
    when = dt.datetime(2024, 1, 1)
    files = spark.createDataFrame([(str(i), when, bytearray(h.encode())) for i, h in enumerate(html)] + [("bad", when, bytearray(b"\xff</html>")), ("none", when, None)],
                                  "path string, modificationTime timestamp, content binary")
    found = extract_documents(files, DS2, HtmlColumns(labels))
    assert "Python" not in found._jdf.queryExecution().executedPlan().toString()
    rows = {r.path: r for r in found.collect()}
    documents = {p: json.loads(r.json) for p, r in rows.items() if r.json and r.error is None}
    assert {p: (d["header"]["client"], d["header"]["invoice_date"], d["items"][0]["item_desc"]) for p, d in documents.items() if p != "none"} == {
        "0": ("", None, '"é" \\'), "1": ("second", "2024-01-02", None), "3": (None, None, None)}
    assert rows["2"].error == "ValueError: truncated document" and rows["bad"].error.startswith("UnicodeDecodeError")
    assert list(json.loads(extract_documents(files, DS1, HtmlColumns(labels)).first().json)) == ["gt_parse"]


def test_text_in_place_of_a_document_can_be_unwrapped(spark):
    rows = spark.createDataFrame([("p", dt.datetime(2024, 1, 1), json.dumps('{"a": 1}')),
                                  ("q", dt.datetime(2024, 1, 1), json.dumps("plain"))],
                                 "path string, modificationTime timestamp, json string")
    kept = [r.raw_json for r in bronze_envelope(rows, DS2).orderBy("file_name_in_R2").collect()]
    assert kept == [json.dumps('{"a": 1}'), '"plain"']
    unwrapped = [r.raw_json for r in bronze_envelope(rows, DS2, unwrap_json_string=True).orderBy("file_name_in_R2").collect()]
    assert unwrapped == ['{"a": 1}', '"plain"']


def test_old_late_file_is_taken(spark, tmp_path):
    """A copy that keeps its old time, put in after newer files were taken."""
    import os
    import time

    inbox, out = tmp_path / "in", tmp_path / "out"

    def run():
        ingest_stream(spark, DS2, str(inbox), str(out), LabelReader, buckets=4).awaitTermination()

    put(inbox, "1.pdf", invoice("O1"))
    run()
    put(inbox, "old [1].pdf", invoice("O2"))
    ten_days_ago = time.time() - 10 * 86400
    os.utime(inbox / "old [1].pdf", (ten_days_ago, ten_days_ago))
    run()
    assert [r[0] for r in lines(spark, out)] == ["O1", "O2"]


def test_retries_keep_both_batches(spark, tmp_path):
    inbox, marker = tmp_path / "in", tmp_path / "marker"
    marker.touch()
    for n in (1, 2):
        put(inbox, f"{n} {{x}}.pdf", invoice(f"O{n}", fail=True))
    run = Run(spark, str(tmp_path / "root"), {2: str(inbox)}, {2: partial(LabelReader, str(marker))}, max_files=1, buckets=4)
    run.ingest()
    now = F.current_timestamp() + F.expr("INTERVAL 2 HOURS")
    first = F.current_timestamp() + F.expr("INTERVAL 3 HOURS")
    marker.unlink()
    assert run.retry_stale(2, now) == 2
    put(inbox, "3.pdf", invoice("O3", fail=True))
    marker.touch()
    run.ingest()
    marker.unlink()
    assert run.retry_stale(2, first) == 1
    names = [r[0] for r in bronze_table(spark, run.root, DS2).select("file_name_in_R2").collect()]
    assert sorted(names) == ["1 {x}.pdf", "2 {x}.pdf", "3.pdf"]
    assert [r[0] for r in lines(spark, run.root)] == ["O1", "O2", "O3"]
