"""Bronze to gold: silver plans, deduplication, upsert, star schema."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.functions import file_name, has_document_suffix
from tallyspark.operators import latest_per_key, unnest_items, upsert, upsert_table
from tallyspark.operators.upsert import read_table
from tallyspark.plans import gold as gold_plans
from tallyspark.plans import silver
from tallyspark.schemas import SILVER_DS2
from tallyspark.session import durable_path
from workload import fixtures as fx
from workload.expected import (
    DS1_DOCS,
    DS2_DOCS,
    GOLD,
    LINES,
    SILVER1,
    SILVER1_COLUMNS,
    SILVER2_COLUMNS,
    silver2,
    with_tables,
)
from workload.registry import query

CUTS = ["1997-01-01", "1999-01-01", "2100-01-01"]


@query("silver_ds1", with_tables(SILVER1, f"SELECT {SILVER1_COLUMNS} FROM silver1"))
def silver_ds1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.silver_ds1_lines(fx.docs(spark, sf_dir, 1))


@query("silver_ds1_all_lines", with_tables(SILVER1, f"SELECT {SILVER1_COLUMNS} FROM ds1_ranked WHERE doc_rank = 1"))
def silver_ds1_all_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.silver_ds1_lines(fx.docs(spark, sf_dir, 1), keep="all_lines")


@query("silver_ds2", with_tables(LINES + "," + DS2_DOCS + "," + silver2("s"), f"SELECT {SILVER2_COLUMNS} FROM s"))
def silver_ds2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.silver_ds2(fx.bronze(spark, sf_dir, 2))


@query("bronze_exclusion", with_tables(DS1_DOCS, "SELECT id FROM ds1_docs WHERE exclude_from_silver = false"))
def bronze_exclusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.included(fx.bronze(spark, sf_dir, 1)).select("id")


@query("unnest_items", """
WITH texts AS (
  SELECT o_orderkey, CASE o_orderkey % 7
    WHEN 0 THEN '{"items":[{"a":' || o_custkey || '},{"a":"x"}]}'
    WHEN 1 THEN '{"items":[]}'
    WHEN 2 THEN '{"other":1}'
    WHEN 3 THEN '{"items":null}'
    WHEN 4 THEN '{"items":{"a":1}}'
    WHEN 5 THEN '{"items":"' || o_orderpriority || '"}'
    ELSE '{"items":[' || o_custkey || ',null,"' || o_orderstatus || '",[1]]}' END AS raw
  FROM orders
), arrays AS (
  SELECT o_orderkey, CAST(json_extract(raw, '$.items') AS JSON[]) AS items FROM texts
  WHERE json_type(raw, '$.items') = 'ARRAY'
)
SELECT o_orderkey, CAST(pos - 1 AS INTEGER) AS pos, json_extract_string(item, '$') AS item
FROM (SELECT o_orderkey, generate_subscripts(items, 1) AS pos, unnest(items) AS item FROM arrays)
""")
def unnest(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = fx.table(spark, sf_dir, "orders")
    shape = F.col("o_orderkey") % 7
    raw = (
        F.when(shape == 0, F.concat(F.lit('{"items":[{"a":'), "o_custkey", F.lit('},{"a":"x"}]}')))
        .when(shape == 1, F.lit('{"items":[]}'))
        .when(shape == 2, F.lit('{"other":1}'))
        .when(shape == 3, F.lit('{"items":null}'))
        .when(shape == 4, F.lit('{"items":{"a":1}}'))
        .when(shape == 5, F.concat(F.lit('{"items":"'), "o_orderpriority", F.lit('"}')))
        .otherwise(F.concat(F.lit('{"items":['), "o_custkey", F.lit(',null,"'), "o_orderstatus", F.lit('",[1]]}')))
    )
    rows = orders.select("o_orderkey", raw.alias("raw"))
    return unnest_items(rows, "raw", "$.items").drop("raw")


@query("dedup_latest", """
SELECT event_id, user_id, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) AS rn FROM events
) WHERE rn = 1
""")
def dedup_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = fx.table(spark, sf_dir, "events").drop("props")
    return latest_per_key(events, ["user_id"], ["-ts", "event_id"]).drop("ts")


@query("dedup_latest_ties", """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber FROM (
  SELECT *, rank() OVER (PARTITION BY l_suppkey ORDER BY l_linenumber DESC) AS r FROM lineitem
) WHERE r = 1
""")
def dedup_latest_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = fx.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
    return latest_per_key(li, ["l_suppkey"], ["-l_linenumber"], ties="all")


def ds2_snapshot(spark: SparkSession, sf_dir: str, before: str) -> DataFrame:
    docs = fx.docs(spark, sf_dir, 2).filter(F.col("inserted_at") < F.lit(before).cast("timestamp"))
    return silver.silver_ds2_lines(docs)


SNAPSHOTS = LINES + "," + DS2_DOCS + "".join("," + silver2(f"s{i}", cut) for i, cut in enumerate(CUTS))
MERGED = f"""
SELECT {SILVER2_COLUMNS} FROM s2
UNION ALL SELECT {SILVER2_COLUMNS} FROM s1
  WHERE unique_invoice_line_no NOT IN (SELECT unique_invoice_line_no FROM s2)
UNION ALL SELECT {SILVER2_COLUMNS} FROM s0
  WHERE unique_invoice_line_no NOT IN (SELECT unique_invoice_line_no FROM s2)
    AND unique_invoice_line_no NOT IN (SELECT unique_invoice_line_no FROM s1)
"""


@query("silver_upsert", with_tables(SNAPSHOTS, f"""
SELECT {SILVER2_COLUMNS} FROM s{len(CUTS) - 1}
UNION ALL SELECT {SILVER2_COLUMNS} FROM s0
  WHERE unique_invoice_line_no NOT IN (SELECT unique_invoice_line_no FROM s{len(CUTS) - 1})
"""))
def silver_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, second = (ds2_snapshot(spark, sf_dir, cut) for cut in (CUTS[0], CUTS[-1]))
    return upsert(first, second, "unique_invoice_line_no")


@query("silver_upsert_batches", with_tables(SNAPSHOTS, MERGED))
def silver_upsert_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = durable_path(spark, "silver-ds2")
    for cut in CUTS:
        upsert_table(spark, path, ds2_snapshot(spark, sf_dir, cut), "unique_invoice_line_no", buckets=8)
    return read_table(spark, path, SILVER_DS2)


@query("gold_dim_buyer", with_tables(GOLD, "SELECT * FROM dim_buyer"))
def gold_dim_buyer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold_plans.dim_buyer(fx.silver(spark, sf_dir))


@query("gold_dim_vendor", with_tables(GOLD, "SELECT * FROM dim_vendor"))
def gold_dim_vendor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold_plans.dim_vendor(fx.silver(spark, sf_dir))


@query("gold_fact", with_tables(GOLD, "SELECT * FROM fact"))
def gold_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold_plans.fact_invoice_line(fx.silver(spark, sf_dir))


@query("gold_star", with_tables(GOLD, """
SELECT 'dim_buyer' AS name, data_source_id, count(*) AS n FROM dim_buyer GROUP BY 2
UNION ALL SELECT 'dim_vendor', data_source_id, count(*) FROM dim_vendor GROUP BY 2
UNION ALL SELECT 'fact_invoice_line', data_source_id, count(*) FROM fact GROUP BY 2
"""))
def gold_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = [
        df.groupBy("data_source_id").agg(F.count(F.lit(1)).alias("n"))
        .select(F.lit(name).alias("name"), "data_source_id", "n")
        for name, df in gold_plans.star(fx.silver(spark, sf_dir)).items()
    ]
    return reduce(DataFrame.unionByName, counts)


@query("file_parts", """
SELECT path, regexp_extract(path, '([^/]*)$', 1) AS file,
  regexp_matches(path, '[.](jpg|jpeg|png|pdf)$') AS is_document
FROM (SELECT 'bucket/unprocessed/' || o_orderkey || CASE o_orderkey % 6 WHEN 0 THEN '.jpg' WHEN 1 THEN '.jpeg'
        WHEN 2 THEN '.png' WHEN 3 THEN '.pdf' WHEN 4 THEN '.PDF' ELSE '.pdf.txt' END AS path FROM orders)
""")
def file_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    suffixes = F.array(*[F.lit(s) for s in (".jpg", ".jpeg", ".png", ".pdf", ".PDF", ".pdf.txt")])
    suffix = F.get(suffixes, (F.col("o_orderkey") % 6).cast("int"))
    paths = fx.table(spark, sf_dir, "orders").select(F.concat(F.lit("bucket/unprocessed/"), "o_orderkey", suffix).alias("path"))
    path = F.col("path")
    return paths.select("path", file_name(path).alias("file"), has_document_suffix(path).alias("is_document"))
