"""Data tests. Each returns the failing rows: an empty result passes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.schemas import GOLD_DB, SILVER_DB

# The declared tests of the silver and gold tables.
NOT_NULL = {
    f"{SILVER_DB}.ds1_invoice_lines": ["unique_invoice_line_no", "unique_invoice_no"],
    f"{SILVER_DB}.ds2_invoice_lines": ["order_id"],
    f"{GOLD_DB}.dim_vendor": ["data_source_id", "vendor_no_id", "vendor_no"],
    f"{GOLD_DB}.dim_buyer": ["data_source_id", "buyer_no_id", "buyer_no"],
    f"{GOLD_DB}.fact_invoice_line": ["data_source_id", "row_id", "unique_invoice_line_no", "unique_invoice_no"],
}
UNIQUE = {
    f"{SILVER_DB}.ds1_invoice_lines": ["unique_invoice_line_no"],
    f"{GOLD_DB}.dim_vendor": ["vendor_no_id"],
    f"{GOLD_DB}.dim_buyer": ["buyer_no_id"],
    f"{GOLD_DB}.fact_invoice_line": ["row_id"],
}
RELATIONSHIPS = [
    (f"{GOLD_DB}.fact_invoice_line", "vendor_no_id", f"{GOLD_DB}.dim_vendor", "vendor_no_id"),
    (f"{GOLD_DB}.fact_invoice_line", "buyer_no_id", f"{GOLD_DB}.dim_buyer", "buyer_no_id"),
]
POSITIVE_QTY = (f"{GOLD_DB}.fact_invoice_line", "item_qty")


class DataQualityError(RuntimeError):
    """At least one data test found failing rows."""


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def unique(df: DataFrame, column: str) -> DataFrame:
    """Repeated values with their number of rows; NULLs are not compared."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n_records"))
    return counts.filter("n_records > 1")


def relationships(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child values without a parent, with their number of rows; NULLs pass.

    Children are counted per value before the join, so a value shared by most rows
    crosses the network once per task.
    """
    values = child.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n_records"))
    keys = parent.select(F.col(parent_column).alias(column))
    return values.join(keys, column, "left_anti")


def singular(df: DataFrame, predicate: Column) -> DataFrame:
    return df.filter(predicate)


def non_positive_qty(fact: DataFrame) -> DataFrame:
    """Zero counts as a failure, NULL does not."""
    return singular(fact.select("item_qty"), F.col("item_qty") <= 0)


def dq_report(tables: dict[str, DataFrame]) -> DataFrame:
    """``check, table, column, failures`` for every declared test on the given tables.

    All row-wise tests of a table share one scan; each uniqueness or relationship test is one
    aggregation.
    """
    parts = [_row_tests(name, df) for name, df in tables.items() if _row_test_columns(name)]
    for name, columns in UNIQUE.items():
        if name in tables:
            parts += [_counted("unique", name, c, unique(tables[name], c), F.count(F.lit(1))) for c in columns]
    for child, column, parent, parent_column in RELATIONSHIPS:
        if child in tables and parent in tables:
            failing = relationships(tables[child], column, tables[parent], parent_column)
            parts.append(_counted("relationships", child, column, failing, F.sum("n_records")))
    return reduce(DataFrame.unionByName, parts)


def _row_test_columns(name: str) -> list[tuple[str, str, Column]]:
    tests = [("not_null", c, F.col(c).isNull()) for c in NOT_NULL.get(name, [])]
    if name == POSITIVE_QTY[0]:
        tests.append(("positive_qty", POSITIVE_QTY[1], F.col(POSITIVE_QTY[1]) <= 0))
    return tests


def _row_tests(name: str, df: DataFrame) -> DataFrame:
    tests = _row_test_columns(name)
    counted = df.agg(*[F.count_if(failing).alias(f"_{i}") for i, (_, _, failing) in enumerate(tests)])
    rows = F.array(*[
        F.struct(F.lit(check).alias("check"), F.lit(name).alias("table"), F.lit(column).alias("column"),
                 F.col(f"_{i}").alias("failures"))
        for i, (check, column, _) in enumerate(tests)
    ])
    return counted.select(F.inline(rows))


def _counted(check: str, table: str, column: str, failing: DataFrame, how_many: Column) -> DataFrame:
    total = failing.agg(F.coalesce(how_many, F.lit(0)).cast("bigint").alias("failures"))
    return total.select(F.lit(check).alias("check"), F.lit(table).alias("table"),
                        F.lit(column).alias("column"), "failures")


def gate(tables: dict[str, DataFrame]) -> DataFrame:
    """Run all tests; raise ``DataQualityError`` naming those that fail."""
    report = dq_report(tables)
    failed = report.filter("failures > 0").collect()  # at most one row per declared test
    if failed:
        raise DataQualityError("; ".join(f"{r.check} {r.table}.{r.column}: {r.failures}" for r in failed))
    return report
