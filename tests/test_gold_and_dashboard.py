import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyspark.operators import quality
from tallyspark.plans import analytics, gold
from tallyspark.schemas import GOLD_DB, SILVER_DB, SILVER_DS1, SILVER_DS2

DAY = dt.date(2024, 1, 1)


def ds1(line="1-c-s-1", client="C", client_tax_id="c", seller="S", seller_tax_id="s", price=2.0, qty=3):
    return (line, "1-c-s", client, client_tax_id, "I", DAY, "1", seller, seller_tax_id, 1.0, 1.0, "d", price, qty, 0.1)


def ds2(line="L", client="C", address="A", rate=5.0, qty=2):
    return (line, "N", client, address, DAY, 0.0, "O", 0.0, "d", rate, qty)


@pytest.fixture
def silver(spark):
    def build(first=(), second=()):
        return {1: spark.createDataFrame(list(first), SILVER_DS1), 2: spark.createDataFrame(list(second), SILVER_DS2)}

    return build


def test_roles_of_source_1_are_swapped(silver):
    tables = silver([ds1()])
    assert tuple(gold.dim_vendor(tables).first()) == ("1", "c-1", "c", "C", "")
    assert tuple(gold.dim_buyer(tables).first()) == ("1", "s-1", "s", "S", "")


def test_first_name_wins_and_null_sorts_first(silver):
    tables = silver([ds1("1", client="B"), ds1("2", client="A"), ds1("3", seller=None), ds1("4", client_tax_id=None)])
    vendors = {r.vendor_no: (r.vendor_no_id, r.vendor_desc) for r in gold.dim_vendor(tables).collect()}
    assert vendors == {"c": ("c-1", "A"), None: (None, "C")}
    assert gold.dim_buyer(tables).first().buyer_desc is None


def test_constant_vendor_needs_a_line(silver):
    assert gold.dim_vendor(silver()).count() == 0
    rows = gold.dim_vendor(silver(second=[ds2("a"), ds2("b")])).collect()
    assert [r.vendor_desc for r in rows] == ["SuperStore"]


def test_fact_keeps_one_row_per_line(silver):
    tables = silver([ds1(client="B", price=9.0), ds1(client="A")], [ds2(rate=5.0), ds2(rate=None), ds2("M", rate=1.0005, qty=1)])
    rows = {(r.data_source_id, r.unique_invoice_line_no): r for r in gold.fact_invoice_line(tables).collect()}
    assert len(rows) == 3
    assert rows["1", "1-c-s-1"].spend == 6.0
    assert rows["2", "L"].spend is None and rows["2", "L"].iban == "" and rows["2", "L"].invoice_no == "O"
    assert rows["2", "M"].spend == 1.001


def model(spark, rows):
    return spark.createDataFrame(rows, "invoice_date date, spend double, item_qty bigint, buyer_desc string, vendor_desc string")


ROWS = [
    (dt.date(2023, 1, 2), 20000.0, 1, "b1", "v1"), (dt.date(2024, 1, 1), 9999.0, 2, "b1", "v2"),
    (dt.date(2024, 3, 5), None, 3, "b2", "v2"), (None, 10000.0, None, None, "v3"),
]


def test_semantic_model_keeps_lines_without_dimension(spark):
    fact = spark.createDataFrame([(DAY, 1.0, 1, "b", "v"), (DAY, 2.0, 1, "x", None)],
                                 "invoice_date date, spend double, item_qty bigint, buyer_no_id string, vendor_no_id string")
    buyer = spark.createDataFrame([("b", "B"), (None, "N")], "buyer_no_id string, buyer_desc string")
    vendor = spark.createDataFrame([("v", "V"), (None, "N")], "vendor_no_id string, vendor_desc string")
    got = analytics.semantic_model(fact, buyer, vendor).orderBy("spend").collect()
    assert [(r.buyer_desc, r.vendor_desc) for r in got] == [("B", "V"), (None, None)]


def test_filters(spark):
    df = model(spark, ROWS)
    assert analytics.semantic_filter(df).count() == 4
    assert analytics.semantic_filter(df, vendors=["v2"], buyers=["b1"]).count() == 1
    assert analytics.semantic_filter(df, dates=[dt.date(2024, 1, 1)]).count() == 4
    assert analytics.semantic_filter(df, dates=tuple(analytics.date_bounds(df).first())).count() == 3


def test_totals_of_nothing_are_zero(spark):
    df = model(spark, ROWS)
    assert tuple(analytics.kpi_totals(df).first()) == (39999.0, 6, 4)
    assert tuple(analytics.kpi_totals(df.limit(0)).first()) == (0.0, 0, 0)
    assert tuple(analytics.kpi_formatted(df).first()) == ("$39,999.00", "6", "4")
    by_date = [tuple(r) for r in analytics.spend_by_date(df).collect()]
    assert by_date == [(None, 10000.0), (dt.date(2023, 1, 2), 20000.0), (dt.date(2024, 1, 1), 9999.0), (dt.date(2024, 3, 5), 0.0)]


def test_shares_bucket_each_line(spark):
    df = model(spark, ROWS)
    got = {r.vendor_desc: r.spend for r in analytics.spend_share(df, "vendor_desc").collect()}
    assert got == {"v1": 20000.0, "Other": 9999.0, "v2": 0.0, "v3": 10000.0}
    shares = analytics.spend_share(df, "buyer_desc").collect()
    assert sum(r.share for r in shares) == pytest.approx(1.0)
    assert analytics.spend_share(df.limit(0), "buyer_desc").count() == 0


def test_treemap_levels(spark):
    got = {(r.level, r.vendor_desc, r.buyer_desc): r.spend for r in analytics.spend_treemap(model(spark, ROWS)).collect()}
    assert got[0, None, None] == 39999.0 and got[1, "v2", None] == 9999.0
    assert got[2, "v3", None] == 10000.0 and got[1, "v3", None] == 10000.0 and len(got) == 8


def test_heatmap_merges_years_and_keeps_calendar_order(spark):
    df = model(spark, ROWS)
    full = analytics.heatmap_pivot(df)
    assert full.columns == ["weekday_num", "weekday", *analytics.MONTHS]
    trimmed = analytics.heatmap_pivot(df, drop_empty=True)
    assert trimmed.columns == ["weekday_num", "weekday", "Jan", "Mar"]
    assert [tuple(r) for r in trimmed.collect()] == [(1, "Monday", 2, 0), (2, "Tuesday", 0, 1)]


def test_items(spark):
    fact = spark.createDataFrame(
        [(DAY, "red,  plate", 1, 1.0), (DAY, " red plate", None, None), (dt.date(2023, 1, 1), "red plate", None, None),
         (DAY, "blue", 1, 1.0), (DAY, None, 1, 1.0), (DAY, None, 1, 1.0)],
        "invoice_date date, item_desc string, item_qty bigint, spend double")
    assert [r[0] for r in analytics.frequent_items(fact).collect()] == [None, "red plate"]
    assert [tuple(r) for r in analytics.item_evolution(fact, "red plate").collect()] == [
        (dt.date(2023, 1, 1), None, None), (DAY, 1, 1.0)]


def named(spark, rows):
    """Lines with keys, and the dimension of each name."""
    fact = model(spark, rows).withColumns({"buyer_no_id": F.col("buyer_desc"), "vendor_no_id": F.col("vendor_desc")})
    dims = {n: fact.select(F.col(f"{n}_desc").alias(f"{n}_no_id"), f"{n}_desc").dropna().distinct() for n in ("buyer", "vendor")}
    return fact.drop("buyer_desc", "vendor_desc"), dims


def test_pick_lists_and_export(spark):
    fact, dims = named(spark, ROWS)
    assert [r[0] for r in analytics.filter_options(fact, dims["buyer"], "buyer").collect()] == [None, "b1", "b2"]
    from tallyspark.sources.export import to_columns
    assert to_columns(analytics.filter_options(fact, dims["vendor"], "vendor")).to_pydict() == {"vendor_desc": ["v1", "v2", "v3"]}


def test_only_needed_joins(spark):
    fact, dims = named(spark, ROWS)

    def plan(df):
        return df._jdf.queryExecution().optimizedPlan().toString()

    slim = analytics.semantic_model(fact)
    for df in (analytics.kpi_totals(slim), analytics.spend_by_date(slim), analytics.heatmap_counts(slim)):
        assert "Join" not in plan(df)
    options = plan(analytics.filter_options(fact, dims["buyer"], "buyer"))
    assert options.count("Join") == 1 and "Aggregate" in options.split("Join")[1]
    assert plan(analytics.semantic_model(fact, vendor=dims["vendor"])).count("Join") == 1


def all_tables(silver_tables):
    tables = {f"{SILVER_DB}.ds{i}_invoice_lines": df for i, df in silver_tables.items()}
    return tables | {f"{GOLD_DB}.{n}": df for n, df in gold.star(silver_tables).items()}


def test_clean_tables_pass_all_twenty_tests(silver):
    report = quality.gate(all_tables(silver([ds1()], [ds2()])))
    rows = report.collect()
    assert len(rows) == 20 and not any(r.failures for r in rows)


def test_each_kind_of_violation_is_found(spark, silver):
    tables = all_tables(silver([ds1(), ds1("2", client_tax_id=None, qty=0)], [ds2(qty=None)]))
    fact = f"{GOLD_DB}.fact_invoice_line"
    tables[fact] = tables[fact].unionByName(
        tables[fact].filter("data_source_id = '2'").withColumns({"vendor_no_id": F.lit("?"), "item_qty": F.lit(-1).cast("bigint")}))
    failures = {(r.check, r.table.split(".")[1], r.column): r.failures for r in quality.dq_report(tables).collect() if r.failures}
    assert failures == {
        ("not_null", "dim_vendor", "vendor_no_id"): 1, ("not_null", "dim_vendor", "vendor_no"): 1,
        ("unique", "fact_invoice_line", "row_id"): 1, ("relationships", "fact_invoice_line", "vendor_no_id"): 1,
        ("positive_qty", "fact_invoice_line", "item_qty"): 2,
    }
    with pytest.raises(quality.DataQualityError, match="positive_qty"):
        quality.gate(tables)
