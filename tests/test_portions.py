"""Portions that are worked on together leave what each of them by itself would have."""

from __future__ import annotations

import json
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from tallyspark.operators.quality import DataQualityError
from tallyspark.plans.silver import silver_ds1_lines, silver_ds2_lines
from tallyspark.sources.registry import DS1, DS2
from tallyspark.streaming import ingest
from tallyspark.streaming.ingest import Layout, load_files

cloudpickle.register_pickle_by_value(sys.modules[__name__])


class Reader:
    def extract(self, content):
        return json.loads(bytes(content)) or None

    def close(self):
        pass


def ds1(number, *items):
    return {"header": {"Invoice no": number, "Invoice date": "2024-01-02", "Seller": "S", "Buyer": "B", "Seller tax id": "s", "Client tax id": "c"},
            "items": [{"Description": i, "Quantity": "1", "Price": "2.5"} for i in items], "summary": {}}


def ds2(order, item, qty="1", client="C"):
    return {"header": {"Bill To": client, "Address": "A", "Date": "2024-01-02"},
            "items": [{"Item": item, "Quantity": qty, "Rate": "$2.5"}], "summary": {"order": order}}


def queue(spark, folder, portions):
    """One file per document: (path, portion)."""
    folder.mkdir()
    rows = []
    for portion, documents in enumerate(portions):
        for n, labels in enumerate(documents):
            (folder / f"{portion}-{n}.pdf").write_text(json.dumps(labels))
            rows.append((str(folder / f"{portion}-{n}.pdf"), portion))
    return spark.createDataFrame(rows, "path string, portion int")


def tables(spark, layout):
    store = layout.store(spark)
    found = {}
    for name, hidden in (("silver", ()), ("bronze", ("inserted_at",)), ("documents", ("inserted_at",)), ("ledger", ("last_modified",)),
                         ("rejected", ()), ("quarantine", ("inserted_at",))):
        found[name] = sorted(map(repr, store.read(name).drop(*hidden).collect()))
    return found


@pytest.mark.parametrize("spec", [DS1, DS2], ids=["ds1", "ds2"])
def test_portions_together_leave_what_each_by_itself_would(spark, tmp_path, spec):
    """Documents of one invoice come in several portions, some after it is in the tables."""
    if spec is DS1:
        portions = [[ds1("A", "m"), ds1("B", "x")], [ds1("A", "z", "a"), ds1("C", "q"), {}], [ds1("A", "b"), ds1("A", "n"), ds1("B", "x")]]
    else:
        portions = [[ds2("A", "pen"), ds2("B", "cup")], [ds2("A", "ink", "2"), ds2("C", "cup"), {}, ds2("C", "cup", client="D")],
                    [ds2("A", "pen", "3"), ds2("B", "cup", "7")]]
    files = queue(spark, tmp_path / "in", portions)
    each, both = Layout(str(tmp_path / "each"), spec, 4), Layout(str(tmp_path / "both"), spec, 4)
    for n in range(len(portions)):
        load_files(files.filter(F.col("portion") == n), each, [1, n], Reader)
    load_files(files.filter("portion = 0"), both, [1, 0], Reader)
    load_files(files.filter("portion > 0"), both, [1, 1], Reader)
    before = both.store(spark).version().number
    assert tables(spark, both) == tables(spark, each) and tables(spark, both)["silver"]
    assert before == 4 < each.store(spark).version().number  # a note of what is taken up and the load, twice
    load_files(files.filter("portion > 0"), both, [1, 1], Reader)
    assert both.store(spark).version().number == before


def test_portions_that_fail_are_told_apart(spark, tmp_path, monkeypatch):
    """Of four, one breaks a data test and one would update a line from two rows."""
    portions = [[ds2("A", "pen")], [ds2("B", "cup", "0")], [ds2("A", "pen", "2"), ds2("A", "pen", "2", client="D")], [ds2("E", "pen")]]
    files = queue(spark, tmp_path / "in", portions)
    layout = Layout(str(tmp_path / "kept"), DS2, 4)
    load_files(files, layout, [1, 0], Reader, "continue")
    found = tables(spark, layout)
    assert [r.order_id for r in layout.store(spark).read("silver").orderBy("order_id").collect()] == ["A", "E"]
    states = {r.file: (r.state, (r.outcome or "").split(":")[0]) for r in layout.store(spark).read("ledger").collect()}
    assert states == {"0-0.pdf": ("processed", "done"), "1-0.pdf": ("quarantined", "failed_tests"), "2-0.pdf": ("quarantined", "failed_tests"),
                      "2-1.pdf": ("quarantined", "failed_tests"), "3-0.pdf": ("processed", "done")}
    assert len(found["quarantine"]) == 3 and len(found["bronze"]) == 2

    layout = Layout(str(tmp_path / "stopped"), DS2, 4)
    some = files.filter("portion IN (0, 1, 3)")
    with pytest.raises(DataQualityError):
        load_files(some, layout, [1, 0], Reader)
    states = {r.file: r.state for r in layout.store(spark).read("ledger").collect()}
    assert states == {"0-0.pdf": "processed", "1-0.pdf": "startedprocessing", "3-0.pdf": "unprocessed"}
    load_files(some, layout, [1, 0], Reader)
    assert [r.order_id for r in layout.store(spark).read("silver").orderBy("order_id").collect()] == ["A", "E"]


def test_a_stream_takes_many_portions_at_a_time(spark, tmp_path, monkeypatch):
    taken = []
    monkeypatch.setattr(ingest, "load_files", lambda files, layout, number, *_: taken.append((number, files.select("portion").distinct().count())))
    (tmp_path / "in").mkdir()
    for n in range(40):
        (tmp_path / "in" / f"{n}.pdf").write_text("{}")
    ingest.ingest_stream(spark, DS2, str(tmp_path / "in"), str(tmp_path / "out"), Reader, max_files=1, buckets=4).awaitTermination()
    assert taken == [([1, 0], 32), ([1, 1], 8)]


@pytest.mark.parametrize("keep", ["one_line", "all_lines"])
def test_plans_within_groups(spark, keep):
    """The same documents twice, and fewer of them, are three calls of the plan."""
    def doc(i, invoice, day, *texts):
        return (i, f"2024-01-0{day} 00:00:00", invoice, [(t, "1", "2", "3") for t in texts])

    rows = [doc("a", "A", 1, "m", "b"), doc("b", "A", 2, "z", "a", "m"), doc("c", None, 1, "q"), doc("d", None, 2, "r", None)]
    docs = spark.createDataFrame(rows, "id string, day string, invoice_no string, items array<struct<item_desc: string, item_qty: string, item_net_price: string, item_vat: string>>")
    nothing = [F.lit(None).cast("string").alias(c) for c in ("client", "client_tax_id", "iban", "invoice_date", "seller", "seller_tax_id", "total_net_worth", "total_vat")]
    docs = docs.select("*", F.col("day").cast("timestamp").alias("inserted_at"), *nothing)
    parts = {1: docs, 2: docs, 3: docs.filter("id IN ('a', 'c')")}
    together = None
    for n, part in parts.items():
        part = part.withColumn("group", F.lit(n))
        together = part if together is None else together.unionByName(part)
    lines = silver_ds1_lines(together, keep, within=("group",))
    for n, part in parts.items():
        assert sorted(map(repr, lines.filter(F.col("group") == n).drop("group").collect())) == sorted(map(repr, silver_ds1_lines(part, keep).collect()))


def test_source_2_within_groups(spark):
    rows = [("a", 1, "O", "C", [("x", "1", "2")], 1), ("b", 2, "O", "C", [("y", "1", "2")], 1), ("a", 1, "O", "C", [("x", "1", "2")], 2)]
    docs = spark.createDataFrame(rows, "id string, at int, order_id string, client string, items array<struct<item_desc: string, item_rate: string, item_qty: string>>, part int")
    nothing = [F.lit(None).cast("string").alias(c) for c in ("client_address", "invoice_date", "discount", "shipping")]
    docs = docs.select("*", F.timestamp_seconds("at").alias("inserted_at"), *nothing)
    assert sorted((r.part, r.item_desc) for r in silver_ds2_lines(docs, ("part",)).collect()) == [(1, "y"), (2, "x")]
