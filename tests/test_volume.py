"""How much the load moves and writes."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import functions as F

from tallyspark.operators import Store, TableSpec, key_counts
from tallyspark.plans import gold, silver
from tallyspark.schemas import BRONZE, SILVER_DS1, columns
from workload import fixtures as fx

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def ds1_line(key, client):
    return tuple({"unique_invoice_line_no": key, "unique_invoice_no": "i", "client": client}.get(f.name) for f in SILVER_DS1.fields)


def test_fact_lines_are_shuffled_only_if_keys_repeat(spark):
    once = spark.createDataFrame([ds1_line("a", "x"), ds1_line("b", "y"), ds1_line(None, "z")], SILVER_DS1)
    assert "Exchange" not in plan(gold.fact_invoice_line({1: once}))
    twice = once.unionByName(spark.createDataFrame([ds1_line("a", "w"), ds1_line(None, "v")], SILVER_DS1))
    rows = gold.fact_invoice_line({1: twice}).select("unique_invoice_line_no").collect()
    assert sorted(str(r[0]) for r in rows) == ["None", "a", "b"]


def test_documents_of_an_order_lie_together_and_bronze_is_not_shuffled(spark):
    for source_id, order in ((1, r"ds1-(\d+)-"), (2, r"ds2-(\d+)-")):
        bronze = fx.bronze(spark, SF, source_id)
        assert "Exchange" not in plan(bronze)
        places = bronze.select(F.regexp_extract("id", order, 1).alias("k"), F.spark_partition_id().alias("p")).distinct()
        assert places.groupBy("k").count().filter("count > 1").isEmpty()


def test_one_line_per_invoice_moves_one_line_of_a_document(spark):
    docs = fx.docs(spark, SF, 1)
    shuffled = [line for line in silver.silver_ds1_lines(docs)._jdf.queryExecution().optimizedPlan().toString().split("\n") if "WindowGroupLimit" in line or "Window [" in line]
    assert shuffled and not any("items" in line for line in shuffled)


def test_lines_are_placed_where_their_document_meets_the_marks(spark, conf):
    """Shuffled are ranked documents, documents with their texts, marks, and counts: no line by itself."""
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    docs = silver.documents(fx.bronze(spark, SF, 1), silver.DS1).filter("size(items) > 0").withColumn("unique_invoice_no", silver.ds1_invoice_no())
    tree = plan(silver._lines_per_gap(docs, "all_lines"))
    assert tree.count("Exchange hashpartitioning") == 4 and tree.count("Join") == 1
    assert not [line for line in tree.split("\n") if "Exchange hashpartitioning" in line and "text" in line]


def test_staged_tables_are_stored_by_zstd(spark):
    written = [p.name for p in Path(fx.stored_orders(spark, SF).inputFiles()[0].removeprefix("file://")).parent.glob("*.parquet")]
    assert written and all(".zstd." in name for name in written)


def test_tables_without_a_key_are_written_where_they_are(spark, tmp_path):
    store = Store(spark, str(tmp_path), {"t": TableSpec(BRONZE, None, replace=False)}, 8)
    for n in range(9):
        batch = store.transaction()
        batch.put("t", spark.createDataFrame([(str(n), "{}", None, False, "f")], BRONZE))
        batch.commit()
        store.compact()
    assert sorted(r.id for r in store.read("t").collect()) == [str(n) for n in range(9)]
    assert not list(tmp_path.glob("data/t/*/bucket=*")) and len(store.version().tables["t"]) == 2


def test_last_segment_stays_in_place_and_keys_alone_meet_older_rows(spark, tmp_path):
    """Reading moves no row of the last segment, and a batch out of a shuffle is written without another one."""
    store = Store(spark, str(tmp_path), {"t": TableSpec(columns("k string, v bigint"), "k")}, 8)
    for n in range(3):
        batch = store.transaction()
        batch.put("t", spark.range(n, n + 50).selectExpr("CAST(id AS STRING) AS k", f"CAST({n} AS BIGINT) AS v"), check_keys=True, in_place=True)
        batch.commit()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        table = store.read("t")
        assert {r.k: r.v for r in table.collect()} == {str(k): 2 if k >= 2 else k for k in range(52)} and table.count() == 52
        tree = table._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Window" not in tree and tree.count("Join") == 1 and tree.count("Aggregate") == 1  # the keys of later segments
    assert len(list(tmp_path.glob("data/t/*/bucket=*/*.parquet"))) >= 12


def test_key_counts_are_shuffled_once_in_a_first_batch(spark, tmp_path, monkeypatch):
    store, plans = Store(spark, str(tmp_path), {key_counts.TABLE: key_counts.SPEC}, 8), []
    write = Store.write_segment

    def seen(self, table, rows, *rest):
        plans.append(plan(rows))
        return write(self, table, rows, *rest)

    monkeypatch.setattr(Store, "write_segment", seen)
    batch = store.transaction()
    rows = spark.range(100).selectExpr("concat('a', chr(0), id % 90) AS id")
    assert key_counts.apply_changes(batch, key_counts.changes(key_counts.unique_name("t", "id"), rows, "id")) == {"unique t.id": 10}
    batch.commit()
    assert plans[0].count("Exchange hashpartitioning") == 2  # of the changes, and of the counts before, which are none
    assert {(r.test, r.value, r.n_records) for r in key_counts.failing(store).collect()} == {("unique t.id", f"a\x00{k}", 2) for k in range(10)}
