"""Bronze documents derived from the test tables, and the tables built from them.

Source 1 has one document per order (a second version for some), source 2 one per line. What the
documents say is a function of the table rows, so plain SQL over those rows gives the expected
result of every later stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.plans.gold import star
from tallyspark.plans.silver import documents, silver_ds1_lines, silver_ds2
from tallyspark.session import staged
from tallyspark.sources.registry import SOURCES

_built: dict[tuple, object] = {}


def once(spark: SparkSession, sf_dir: str, name: str, build: Callable):
    """Build something once per Spark application and data folder."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _built:
        _built[key] = build()
    return _built[key]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def iso(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM-dd")


def line_hash(key: Column, line: Callable[[str], Column]) -> Column:
    """A hash that names a line item: the whole row is unique, its keys are not."""
    def cents(c: str) -> Column:
        return F.round(line(c) * 100).cast("bigint")

    return F.md5(F.concat_ws(
        "|", key, line("l_partkey"), line("l_suppkey"), line("l_linenumber"), line("l_quantity").cast("bigint"),
        cents("l_extendedprice"), cents("l_discount"), cents("l_tax"), line("l_returnflag"), line("l_linestatus"),
        iso(line("l_shipdate")),
    ))


def orders_with_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order with its customer, its supplier of least key and its lines, which cross the network once.

    Orders without lines and lines without an order are rows too, with NULL in what is missing.
    """
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type")
    li = table(spark, sf_dir, "lineitem").join(part, F.col("l_partkey") == F.col("p_partkey"), "left")
    line = F.struct(
        "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag",
        "l_linestatus", "l_shipdate", "p_name", F.when(F.col("l_linenumber") == 7, F.col("p_type")).alias("heading"))
    # Rows, not lists, are shuffled: lists made before it would have each task sort all it reads.
    per_order = li.select("l_orderkey", line.alias("line")).repartition("l_orderkey").groupBy("l_orderkey").agg(
        F.min("line.l_suppkey").alias("suppkey"), F.collect_list("line").alias("lines"))
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    customer = table(spark, sf_dir, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice").join(
        customer.select("c_custkey", "c_name", "n_name"), F.col("o_custkey") == F.col("c_custkey"), "left").drop("c_custkey")
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    both = orders.join(per_order, F.col("o_orderkey") == F.col("l_orderkey"), "full")
    return both.join(supplier, F.col("suppkey") == F.col("s_suppkey"), "left").drop("s_suppkey")


def stored_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``orders_with_lines`` as a table: both sources make their documents from it row by row."""
    return once(spark, sf_dir, "orders", lambda: staged(orders_with_lines(spark, sf_dir), "orders-with-lines"))


def exclusion(key: Column) -> Column:
    return F.when(key % 17 == 0, True).when(key % 19 == 0, F.lit(None)).otherwise(False)


def ds1_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One document per order, with all of its lines; the seller is the supplier with the least key."""
    key = F.col("o_orderkey")

    def item(i: Column) -> Column:
        return F.struct(
            i["l_linenumber"].alias("l_linenumber"), line_hash(key, lambda c: i[c]).alias("line_hash"), i["p_name"].alias("item_desc"),
            i["l_quantity"].cast("string").alias("item_qty"), i["l_extendedprice"].cast("string").alias("item_net_price"),
            i["l_tax"].cast("string").alias("item_vat"))

    full = (
        stored_orders(spark, sf_dir).filter(key.isNotNull())
        .withColumn("items", F.sort_array(F.transform(F.coalesce("lines", F.array()), item)))
        .withColumn("ver", F.explode(F.when(key % 5 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))))
    )
    day = F.col("o_orderdate")
    header = F.struct(
        F.when(key % 97 != 0, key.cast("string")).alias("invoice_no"),
        F.when(key % 50 == 0, F.date_format(day, "MM/dd/yyyy")).otherwise(iso(day)).alias("invoice_date"),
        F.col("s_name").alias("seller"), F.col("c_name").alias("client"),
        F.col("suppkey").cast("string").alias("seller_tax_id"),
        F.col("o_custkey").cast("string").alias("client_tax_id"),
        F.concat(F.lit("IB"), "o_custkey", F.lit("v"), "ver").alias("iban"),
    )
    items = F.transform(
        "items",
        lambda i: F.struct(i["item_desc"].alias("item_desc"), i["item_qty"].alias("item_qty"),
                           i["item_net_price"].alias("item_net_price"), i["item_vat"].alias("item_vat")),
    )
    summary = F.struct(F.col("o_totalprice").cast("string").alias("total_net_worth"), F.lit("n/a").alias("total_vat"))
    body = F.struct(header.alias("header"), items.alias("items"), summary.alias("summary"))
    return full.select(
        F.concat(F.lit("ds1-"), "o_orderkey", F.lit("-v"), "ver").alias("id"),
        F.to_json(F.struct(body.alias("gt_parse"))).alias("raw_json"),
        (day + F.make_dt_interval(days=F.col("ver") - 1)).cast("timestamp").alias("inserted_at"),
        exclusion(key).alias("exclude_from_silver"),
        F.concat("o_orderkey", F.lit("-"), "ver", F.lit(".jpg")).alias("file_name_in_R2"),
    )


def ds2_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One document per line."""
    full = stored_orders(spark, sf_dir).select("l_orderkey", "c_name", "n_name", F.explode("lines").alias("line")).select(
        "l_orderkey", "c_name", "n_name", "line.*").withColumn("line_hash", line_hash(F.col("l_orderkey"), F.col))
    key, day = F.col("l_orderkey"), F.col("l_shipdate")
    header = F.struct(
        F.when(key % 50 == 0, F.date_format(day, "MMM dd yyyy")).otherwise(iso(day)).alias("invoice_date"),
        F.col("c_name").alias("client"), F.col("n_name").alias("client_address"),
    )
    qty = F.col("l_quantity").cast("bigint").cast("string")
    item = F.struct(
        F.col("p_name").alias("item_desc"),
        F.when(F.col("l_linenumber") == 6, F.concat(qty, F.lit(".0"))).otherwise(qty).alias("item_qty"),
        F.concat(F.lit("$"), F.format_number("l_extendedprice", 2)).alias("item_rate"),
    )
    heading = F.struct(F.col("heading").alias("item_desc"), F.lit(None).cast("string").alias("item_qty"),
                       F.lit(None).cast("string").alias("item_rate"))
    summary = F.struct(
        F.concat(F.lit("OR-"), key).alias("order_id"), F.concat(F.lit("$"), "l_discount").alias("discount"),
        F.concat(F.lit("$"), "l_tax").alias("shipping"),
    )
    items = F.when(F.col("l_linenumber") == 7, F.array(heading, item)).otherwise(F.array(item))
    name = F.concat(F.lit("ds2-"), key, F.lit("-"), "line_hash")
    return full.select(
        name.alias("id"),
        F.to_json(F.struct(header.alias("header"), items.alias("items"), summary.alias("summary"))).alias("raw_json"),
        day.cast("timestamp").alias("inserted_at"),
        exclusion(key).alias("exclude_from_silver"),
        F.concat(name, F.lit(".pdf")).alias("file_name_in_R2"),
    )


def bronze(spark: SparkSession, sf_dir: str, source_id: int) -> DataFrame:
    """Bronze rows, made from stored orders by whoever reads them; documents of an order lie together."""
    return {1: ds1_bronze, 2: ds2_bronze}[source_id](spark, sf_dir)


def docs(spark: SparkSession, sf_dir: str, source_id: int) -> DataFrame:
    """Parsed documents, written once like the load does."""
    return once(spark, sf_dir, f"docs{source_id}", lambda: staged(
        documents(bronze(spark, sf_dir, source_id), SOURCES[source_id]), f"documents-{source_id}"))


def silver(spark: SparkSession, sf_dir: str) -> dict[int, DataFrame]:
    plans = {1: lambda: silver_ds1_lines(docs(spark, sf_dir, 1)), 2: lambda: silver_ds2(bronze(spark, sf_dir, 2))}
    return once(spark, sf_dir, "silver", lambda: {i: staged(plan(), f"silver-{i}") for i, plan in plans.items()})


def gold(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return once(spark, sf_dir, "gold", lambda: {
        name: staged(df, name) for name, df in star(silver(spark, sf_dir)).items()
    })

