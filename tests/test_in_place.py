"""A large batch of documents is not moved into its buckets first."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from tallyspark.operators.versioned import Store
from tallyspark.schemas import BRONZE
from tallyspark.sources.registry import DS2
from tallyspark.streaming import ingest
from tallyspark.streaming.ingest import Layout, load_bronze_batch


def bronze(spark, day, orders):
    def raw(order, item):
        return json.dumps({"header": {"invoice_date": "2024-01-02", "client": "C", "client_address": "A"},
                           "items": [{"item_desc": item, "item_qty": "1", "item_rate": "$2"}], "summary": {"order_id": order}})

    rows = [(f"{day}-{o}", raw(f"O{o}", f"item {day % 2}"), False, "x.pdf") for o in orders]
    return spark.createDataFrame(rows, "id string, raw_json string, exclude_from_silver boolean, file_name_in_R2 string").withColumn(
        "inserted_at", F.timestamp_seconds(F.lit(day))).select(*BRONZE.names)


def test_large_batches_are_written_where_they_are(spark, tmp_path, monkeypatch):
    written, write = [], Store.write_segment

    def noted(self, table, rows, sequence, level, in_place=False):
        written.append((table, in_place))
        return write(self, table, rows, sequence, level, in_place)

    monkeypatch.setattr(Store, "write_segment", noted)
    results = {}
    for least in (1, 10_000):
        written.clear()
        monkeypatch.setattr(ingest, "ROWS_IN_PLACE", least)
        layout = Layout(str(tmp_path / str(least)), DS2, 4)
        for day, orders in ((1, range(200)), (2, range(100, 300))):
            load_bronze_batch(bronze(spark, day, orders).repartition(2), layout, [day])
        assert {in_place for table, in_place in written if table in ("documents", "silver")} == {least == 1}
        results[least] = sorted(map(repr, layout.store(spark).read("silver").collect()))
    assert results[1] == results[10_000] and len(results[1]) == 400
