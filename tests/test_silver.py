"""Silver plans against the literal window formulation, on documents with awkward identifiers."""

import datetime as dt
import json
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyspark.operators import DuplicateKeyError, latest_per_key, upsert_table
from tallyspark.operators.quality import unique
from tallyspark.operators.upsert import read_table
from tallyspark.plans.silver import documents, ds1_invoice_no, silver_ds1, silver_ds1_lines, silver_ds2
from tallyspark.schemas import BRONZE, SILVER_DS2
from tallyspark.sources.registry import DS1, DS2

T0 = dt.datetime(2024, 1, 1)


def bronze(spark, documents, seed):
    rng = random.Random(seed)
    rows = [(f"id{i}", json.dumps(d), T0 + dt.timedelta(days=rng.randrange(4)), rng.choice([False] * 6 + [True, None]),
             f"{i}.pdf") for i, d in enumerate(documents)]
    rng.shuffle(rows)
    return spark.createDataFrame(rows, BRONZE)


def bronze_of(documents, spark):
    return spark.createDataFrame([(f"id{i}", json.dumps(d), T0, False, "f") for i, d in enumerate(documents)], BRONZE)


def ds1_documents(seed, n=300):
    rng = random.Random(seed)
    docs = []
    for _ in range(n):
        header = {"invoice_no": rng.choice([None, "missingin", "1", "2"]), "client_tax_id": rng.choice([None, "c"]),
                  "seller_tax_id": rng.choice(["s", "t-1", None]), "iban": str(rng.random()), "client": rng.choice("AB")}
        items = [{"item_desc": rng.choice([None, "", "a", "b", "é", "b b", "Z"]), "item_qty": rng.choice(["1", "2.5", "x"]),
                  "item_net_price": "3.5"} for _ in range(rng.randrange(5))]
        docs.append({"gt_parse": {"header": header, "items": items, "summary": {}}})
    return docs


def literal_ds1(docs, keep):
    lines = docs.withColumn("inv", ds1_invoice_no()).select("*", F.posexplode("items").alias("pos", "item"))
    numbering = Window.partitionBy("invoice_no", "client_tax_id", "seller_tax_id").orderBy(
        F.col("item.item_desc"), F.col("inserted_at").desc(), "id", "pos")
    numbered = lines.withColumn("k", F.row_number().over(numbering))
    if keep == "one_line":
        numbered = numbered.withColumn("rn", F.row_number().over(
            Window.partitionBy("inv").orderBy(F.col("inserted_at").desc(), "id", "pos")))
    else:
        numbered = numbered.withColumn("rn", F.rank().over(
            Window.partitionBy("inv").orderBy(F.col("inserted_at").desc(), "id")))
    kept = numbered.filter("rn = 1")
    return {(f"{r.inv}-{r.k}", r.iban, r.item.item_desc) for r in kept.collect()}, kept.count()


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("keep", ["one_line", "all_lines"])
def test_ds1_equals_literal_windows(spark, seed, keep):
    rows = bronze(spark, ds1_documents(seed), seed)
    expected, n = literal_ds1(documents(rows, DS1), keep)
    got = silver_ds1(rows, keep).collect()
    assert len(got) == n
    assert {(r.unique_invoice_line_no, r.iban, r.item_desc) for r in got} == expected


def test_ds1_casts(spark):
    document = {"gt_parse": {"header": {"invoice_no": "1", "invoice_date": "03/04/2021"},
                             "items": [{"item_desc": "a", "item_qty": "2.5", "item_net_price": "1,5", "item_vat": "0.2"}],
                             "summary": {"total_net_worth": "12.5", "total_vat": "n/a"}}}
    rows = spark.createDataFrame([("x", json.dumps(document), T0, False, "f")], BRONZE)
    r = silver_ds1(rows).first()
    assert (r.invoice_date, r.item_qty, r.item_net_price, r.item_vat, r.total_net_worth, r.total_vat) == (
        None, 3, None, 0.2, 12.5, None)
    assert r.unique_invoice_line_no == "1-missingcti-missingsti-1"


def test_ds1_rejects_unknown_mode(spark):
    with pytest.raises(ValueError):
        silver_ds1_lines(spark.createDataFrame([], "items array<int>"), "some")


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_ds2_equals_literal_windows(spark, seed):
    rng = random.Random(seed)
    docs = []
    for _ in range(300):
        items = [{"item_desc": rng.choice("abc"), "item_rate": rng.choice([None, "$1,000.5", "x"]),
                  "item_qty": rng.choice([None, "2", "2.0"])} for _ in range(rng.randrange(4))]
        docs.append({"header": {"client": rng.choice([None, "A", "B"]), "client_address": str(rng.random())},
                     "items": items, "summary": {"order_id": rng.choice([None, "1", "2", "3"])}})
    rows = bronze(spark, docs, seed)
    lines = documents(rows, DS2).select("*", F.posexplode("items").alias("pos", "item")).filter(
        "item.item_rate IS NOT NULL OR item.item_qty IS NOT NULL")
    latest = latest_per_key(lines, ["order_id", "client"], ["-inserted_at", "id", "pos"])
    expected = {(r.order_id, r.client, r.client_address, r.item.item_desc) for r in latest.collect()}
    got = silver_ds2(rows).collect()
    assert len(got) == len(expected)
    assert {(r.order_id, r.client, r.client_address, r.item_desc) for r in got} == expected
    assert {r.item_rate for r in got} <= {None, 1000.5} and {r.item_qty for r in got} <= {None, 2}


def test_two_clients_on_one_order_conflict(spark, tmp_path):
    """The line key leaves out the client: both lines enter a new table, a later merge refuses them."""
    rows = bronze_of([{"header": {"client": c}, "items": [{"item_desc": "pen", "item_qty": "1"}],
                       "summary": {"order_id": "O"}} for c in "AB"], spark)
    lines = silver_ds2(rows)
    assert [r.n_records for r in unique(lines, "unique_invoice_line_no").collect()] == [2]
    path = str(tmp_path / "lines")
    upsert_table(spark, path, lines, "unique_invoice_line_no", buckets=4)
    assert read_table(spark, path, SILVER_DS2).count() == 2
    with pytest.raises(DuplicateKeyError):
        upsert_table(spark, path, lines, "unique_invoice_line_no", buckets=4)


def test_latest_with_ties(spark):
    rows = spark.createDataFrame([(1, 5, "a"), (1, 5, "b"), (1, 4, "c"), (None, None, "d"), (None, None, "e")],
                                 "k int, v int, t string")
    assert {r.t for r in latest_per_key(rows, ["k"], ["-v"], ties="all").collect()} == {"a", "b", "d", "e"}
    assert {r.t for r in latest_per_key(rows, ["k"], ["-v", "t"]).collect()} == {"a", "d"}
    with pytest.raises(ValueError):
        latest_per_key(rows, ["k"], ["v"], ties="few")


def test_hot_invoice_is_split(spark, conf):
    """A third of all lines under one all-NULL identifier: the counting join is split by AQE."""
    rng = random.Random(7)
    docs = []
    for i in range(6000):
        no = None if i % 3 == 0 else str(i)
        items = [{"item_desc": f"{rng.random()}"} for _ in range(5)]
        docs.append({"gt_parse": {"header": {"invoice_no": no}, "items": items, "summary": {}}})
    rows = spark.createDataFrame(
        [(f"id{i:05}", json.dumps(d), T0, False, "f") for i, d in enumerate(docs)], BRONZE).repartition(8)
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
         spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20KB",
         spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5",
         spark__sql__adaptive__advisoryPartitionSizeInBytes="20KB")
    result = silver_ds1(rows)
    got = {r.unique_invoice_line_no for r in result.collect()}
    assert "skew=true" in result._jdf.queryExecution().executedPlan().toString()
    first = sorted(d["item_desc"] for i, doc in enumerate(docs) if i % 3 == 0 for d in doc["gt_parse"]["items"])
    number = first.index(docs[0]["gt_parse"]["items"][0]["item_desc"]) + 1
    assert f"missingin-missingcti-missingsti-{number}" in got and len(got) == 4001


def test_plans_limit_groups_before_the_shuffle(spark, tmp_path):
    rows = bronze(spark, ds1_documents(1), 1)
    documents(rows, DS1).write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    plan = silver_ds1_lines(docs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("row_number(), 1, Partial") == 2
    spark.createDataFrame(rows.collect(), BRONZE).write.parquet(str(tmp_path / "bronze"))
    plan = documents(spark.read.parquet(str(tmp_path / "bronze")), DS1)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(exclude_from_silver,false)" in plan or "Not(EqualTo(exclude_from_silver,true))" in plan
    assert "file_name_in_R2" not in plan


def test_long_documents_keep_all_lines(spark):
    """Hundreds of lines with equal and NULL descriptions, in two versions and a shorter one."""
    def long(version, n):
        rng = random.Random(version)
        items = [{"item_desc": rng.choice([None, *(f"d{k}" for k in range(150))]), "item_qty": "1", "item_net_price": "2"} for _ in range(n)]
        return {"gt_parse": {"header": {"invoice_no": "1", "client_tax_id": "c", "seller_tax_id": "s"}, "items": items, "summary": {}}}

    docs = documents(bronze(spark, [long(v, n) for v, n in enumerate((400, 30, 350))], 1).withColumn("exclude_from_silver", F.lit(False)), DS1)
    want, count = literal_ds1(docs, "all_lines")
    got = [(r.unique_invoice_line_no, r.iban, r.item_desc) for r in silver_ds1_lines(docs, "all_lines").collect()]
    assert len(got) == count == len(set(got)) and count in (400, 30, 350) and set(got) == want
