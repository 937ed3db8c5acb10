"""Data tests and dashboard datasets over the gold tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.operators import quality
from tallyspark.plans import analytics
from tallyspark.schemas import DIM_BUYER, DIM_VENDOR, FACT_INVOICE_LINE, GOLD_DB, SILVER_DB
from tallyspark.sources.export import to_columns
from workload import fixtures as fx
from workload.expected import GOLD, MODEL, with_tables
from workload.registry import query

DATES = ("1996-01-01", "1997-12-31")
VENDORS = ("Customer#000000001", "SuperStore")
ITEM = "red plate"


def model(spark: SparkSession, sf_dir: str) -> DataFrame:
    gold = fx.gold(spark, sf_dir)
    return analytics.semantic_model(gold["fact_invoice_line"], gold["dim_buyer"], gold["dim_vendor"])


def slim(spark: SparkSession, sf_dir: str, *names: str) -> DataFrame:
    """The model with the named dimensions only."""
    gold = fx.gold(spark, sf_dir)
    return analytics.semantic_model(gold["fact_invoice_line"], **{n: gold[f"dim_{n}"] for n in names})


def dated(spark: SparkSession, sf_dir: str, *names: str) -> DataFrame:
    """What the dashboard shows first: from the first date to the last, which leaves out lines without one."""
    return slim(spark, sf_dir, *names).filter(F.col("invoice_date").isNotNull())


def fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.gold(spark, sf_dir)["fact_invoice_line"]


def cents(df: DataFrame, *columns: str, places: int = 2) -> DataFrame:
    """Sums of floats depend on their order in the last digits; compare them rounded."""
    return df.withColumns({c: F.round(c, places) for c in columns})


@query("semantic_model", with_tables(MODEL, "SELECT * FROM model"))
def semantic_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return model(spark, sf_dir)


@query("semantic_filter", with_tables(
    MODEL, "SELECT * FROM model WHERE invoice_date BETWEEN DATE '1996-01-01' AND DATE '1997-12-31' "
           "AND vendor_desc IN ('Customer#000000001', 'SuperStore')"))
def semantic_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.semantic_filter(model(spark, sf_dir), vendors=VENDORS, dates=DATES)


@query("kpi_totals", with_tables(MODEL, """
SELECT round(coalesce(sum(spend), 0), 2) AS total_spend, CAST(coalesce(sum(item_qty), 0) AS BIGINT) AS total_qty,
  count(*) AS records FROM dated
"""))
def kpi_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cents(analytics.kpi_totals(dated(spark, sf_dir)), "total_spend")


@query("kpi_formatted", with_tables(MODEL, """
SELECT '$' || format('{:,.2f}', coalesce(sum(spend), 0)) AS total_spend,
  format('{:,}', CAST(coalesce(sum(item_qty), 0) AS BIGINT)) AS total_qty, format('{:,}', count(*)) AS records FROM dated
"""))
def kpi_formatted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.kpi_formatted(dated(spark, sf_dir))


@query("spend_by_date", with_tables(MODEL, """
SELECT invoice_date, round(coalesce(sum(spend), 0), 2) AS spend FROM dated GROUP BY 1 ORDER BY 1
"""))
def spend_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cents(analytics.spend_by_date(dated(spark, sf_dir)), "spend")


@query("spend_treemap", with_tables(MODEL, """
SELECT vendor_desc, buyer_desc, CASE grouping(vendor_desc, buyer_desc) WHEN 0 THEN 2 WHEN 1 THEN 1 ELSE 0 END AS level,
  round(coalesce(sum(spend), 0), 2) AS spend FROM dated GROUP BY ROLLUP (vendor_desc, buyer_desc)
"""))
def spend_treemap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cents(analytics.spend_treemap(dated(spark, sf_dir, "buyer", "vendor")), "spend")


def share_sql(name: str) -> str:
    return with_tables(MODEL, f"""
SELECT CASE WHEN spend < 10000 THEN 'Other' ELSE {name} END AS {name}, round(coalesce(sum(spend), 0), 2) AS spend,
  round(coalesce(sum(spend), 0) / nullif((SELECT sum(spend) FROM dated), 0), 6) AS share
FROM dated GROUP BY 1
""")


@query("spend_share_vendor", share_sql("vendor_desc"))
def spend_share_vendor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cents(cents(analytics.spend_share(dated(spark, sf_dir, "vendor"), "vendor_desc"), "spend"), "share", places=6)


@query("spend_share_buyer", share_sql("buyer_desc"))
def spend_share_buyer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cents(cents(analytics.spend_share(dated(spark, sf_dir, "buyer"), "buyer_desc"), "spend"), "share", places=6)


NORMALISED = "regexp_replace(trim(replace(item_desc, ',', '')), '[ \\t\\n\\f\\r]+', ' ', 'g')"


@query("frequent_items", with_tables(GOLD, f"""
SELECT {NORMALISED} AS cleaned_desc FROM fact GROUP BY 1 HAVING count(*) > 1 ORDER BY 1
"""))
def frequent_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.frequent_items(fact(spark, sf_dir))


@query("item_evolution", with_tables(GOLD, f"""
SELECT invoice_date, CAST(sum(item_qty) AS BIGINT) AS total_qty, round(sum(spend), 2) AS total_spend
FROM fact WHERE {NORMALISED} = '{ITEM}' GROUP BY 1 ORDER BY 1
"""))
def item_evolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cents(analytics.item_evolution(fact(spark, sf_dir), ITEM), "total_spend")


@query("heatmap_counts", with_tables(MODEL, """
SELECT strftime(invoice_date, '%b') AS month, strftime(invoice_date, '%A') AS weekday,
  CAST(isodow(invoice_date) AS INTEGER) AS weekday_num, count(*) AS invoice_count
FROM model GROUP BY 1, 2, 3
"""))
def heatmap_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.heatmap_counts(slim(spark, sf_dir))


MONTH_COLUMNS = ", ".join(
    f'count(*) FILTER (month(invoice_date) = {i}) AS "{m}"' for i, m in enumerate(analytics.MONTHS, start=1)
)


@query("heatmap_pivot", with_tables(MODEL, f"""
SELECT CAST(isodow(invoice_date) AS INTEGER) AS weekday_num, strftime(invoice_date, '%A') AS weekday, {MONTH_COLUMNS}
FROM model WHERE invoice_date IS NOT NULL GROUP BY 1, 2
"""))
def heatmap_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.heatmap_pivot(slim(spark, sf_dir))


@query("filter_options", with_tables(MODEL, """
SELECT 'vendor' AS list, vendor_desc AS name FROM model GROUP BY 2
UNION ALL SELECT 'buyer', buyer_desc FROM model GROUP BY 2
"""))
def filter_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    gold = fx.gold(spark, sf_dir)
    lists = [
        analytics.filter_options(gold["fact_invoice_line"], gold[f"dim_{n}"], n).select(F.lit(n).alias("list"), F.col(f"{n}_desc").alias("name"))
        for n in ("vendor", "buyer")
    ]
    return lists[0].unionByName(lists[1])


@query("date_bounds", with_tables(MODEL, "SELECT min(invoice_date) AS min_date, max(invoice_date) AS max_date FROM model"))
def date_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.date_bounds(slim(spark, sf_dir))


@query("result_export", with_tables(MODEL, """
SELECT invoice_date, round(coalesce(sum(spend), 0), 2) AS spend FROM dated GROUP BY 1
"""))
def result_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    exported = to_columns(spend_by_date(spark, sf_dir))
    return spark.createDataFrame(exported)


# Gold with violations planted by rule on many rows.
SEEDED = GOLD + """,
seeded_vendor AS (SELECT * REPLACE (CASE WHEN vendor_no LIKE '%7' THEN NULL ELSE vendor_no_id END AS vendor_no_id) FROM dim_vendor),
seeded_buyer AS (SELECT * FROM dim_buyer UNION ALL SELECT * FROM dim_buyer WHERE buyer_no LIKE '%3'),
seeded_fact AS (SELECT * REPLACE (
    CASE item_qty WHEN 13 THEN 'unknown ' || item_desc WHEN 17 THEN NULL ELSE vendor_no_id END AS vendor_no_id,
    CASE item_qty WHEN 1 THEN 0 WHEN 2 THEN -1 WHEN 3 THEN NULL ELSE item_qty END AS item_qty) FROM fact)"""


def seeded(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    gold = fx.gold(spark, sf_dir)
    vendor, buyer, lines = gold["dim_vendor"], gold["dim_buyer"], gold["fact_invoice_line"]
    qty = F.col("item_qty")
    broken_key = (
        F.when(qty == 13, F.concat(F.lit("unknown "), "item_desc")).when(qty == 17, F.lit(None)).otherwise(F.col("vendor_no_id"))
    )
    broken_qty = F.when(qty == 1, 0).when(qty == 2, -1).when(qty == 3, F.lit(None)).otherwise(qty)
    return {
        "dim_vendor": vendor.withColumn(
            "vendor_no_id", F.when(~F.col("vendor_no").endswith("7") | F.col("vendor_no").isNull(), F.col("vendor_no_id"))
        ).select(*DIM_VENDOR.names),
        "dim_buyer": buyer.unionByName(buyer.filter(F.col("buyer_no").endswith("3"))).select(*DIM_BUYER.names),
        "fact_invoice_line": lines.withColumns({"vendor_no_id": broken_key, "item_qty": broken_qty})
        .select(*FACT_INVOICE_LINE.names),
    }


@query("dq_not_null", with_tables(SEEDED, "SELECT * FROM seeded_vendor WHERE vendor_no_id IS NULL"))
def dq_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.not_null(seeded(spark, sf_dir)["dim_vendor"], "vendor_no_id")


@query("dq_unique", with_tables(SEEDED, """
SELECT buyer_no_id, count(*) AS n_records FROM seeded_buyer WHERE buyer_no_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1
"""))
def dq_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.unique(seeded(spark, sf_dir)["dim_buyer"], "buyer_no_id")


@query("dq_relationships", with_tables(SEEDED, """
SELECT vendor_no_id, count(*) AS n_records FROM seeded_fact
WHERE vendor_no_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM seeded_vendor v WHERE v.vendor_no_id = seeded_fact.vendor_no_id)
GROUP BY 1
"""))
def dq_relationships(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = seeded(spark, sf_dir)
    return quality.relationships(tables["fact_invoice_line"], "vendor_no_id", tables["dim_vendor"], "vendor_no_id")


@query("dq_positive_qty", with_tables(SEEDED, "SELECT item_qty FROM seeded_fact WHERE item_qty <= 0"))
def dq_positive_qty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.non_positive_qty(seeded(spark, sf_dir)["fact_invoice_line"])


TABLE_SQL = {
    f"{SILVER_DB}.ds1_invoice_lines": "silver1", f"{SILVER_DB}.ds2_invoice_lines": "silver2",
    f"{GOLD_DB}.dim_vendor": "seeded_vendor", f"{GOLD_DB}.dim_buyer": "seeded_buyer",
    f"{GOLD_DB}.fact_invoice_line": "seeded_fact",
}


def report_sql() -> str:
    def row(check: str, table: str, column: str, failures: str) -> str:
        return f"""SELECT '{check}' AS "check", '{table}' AS "table", '{column}' AS "column", {failures} AS failures"""

    rows = [
        row("not_null", t, c, f"(SELECT count(*) FROM {TABLE_SQL[t]} WHERE {c} IS NULL)")
        for t, columns in quality.NOT_NULL.items() for c in columns
    ]
    rows += [
        row("unique", t, c, f"(SELECT count(*) FROM (SELECT {c} FROM {TABLE_SQL[t]} WHERE {c} IS NOT NULL "
                            f"GROUP BY 1 HAVING count(*) > 1))")
        for t, columns in quality.UNIQUE.items() for c in columns
    ]
    rows += [
        row("relationships", t, c, f"(SELECT count(*) FROM {TABLE_SQL[t]} WHERE {c} IS NOT NULL AND {c} NOT IN "
                                   f"(SELECT {pc} FROM {TABLE_SQL[p]} WHERE {pc} IS NOT NULL))")
        for t, c, p, pc in quality.RELATIONSHIPS
    ]
    table, column = quality.POSITIVE_QTY
    rows.append(row("positive_qty", table, column, f"(SELECT count(*) FROM {TABLE_SQL[table]} WHERE {column} <= 0)"))
    return with_tables(SEEDED, " UNION ALL ".join(rows))


@query("dq_report", report_sql())
def dq_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver = fx.silver(spark, sf_dir)
    tables = {f"{SILVER_DB}.ds{i}_invoice_lines": df for i, df in silver.items()}
    tables |= {f"{GOLD_DB}.{name}": df for name, df in seeded(spark, sf_dir).items()}
    return quality.dq_report(tables)
