"""Uniqueness and relationship tests that cost a batch, not the table.

For every value that a test looks at, a store keeps how many child rows and how many parent rows have it. A batch
brings changes, +1 for a row that comes and -1 for one that goes or is replaced. Only the buckets of the values it
changes are read, and the number of failures is carried on from version to version by what the batch changes of it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.operators.versioned import Store, TableSpec, Transaction, Version
from tallyspark.schemas import columns

COUNTS = columns("key string, test string, value string, children bigint, parents bigint, children_before bigint, parents_before bigint")
TABLE = "key_counts"
SPEC = TableSpec(COUNTS, "key")


def unique_name(table: str, column: str) -> str:
    return f"unique {table}.{column}"


def relationship_name(child: str, column: str, parent: str, parent_column: str) -> str:
    return f"relationships {child}.{column} {parent}.{parent_column}"


def changes(test: str, rows: DataFrame, column: str, sign: int = 1, parent: bool = False) -> DataFrame:
    """What rows that come (``sign`` 1) or go (-1) change of the counts of a test. NULLs are not looked at."""
    own, other = F.lit(sign).cast("long"), F.lit(0).cast("long")
    kept = rows.filter(F.col(column).isNotNull())
    return kept.select(F.lit(test).alias("test"), F.col(column).cast("string").alias("value"),
                       (other if parent else own).alias("children"), (own if parent else other).alias("parents"))


def _failures(children: Column, parents: Column) -> Column:
    """Failures that one value stands for: itself if it is not unique, or its child rows if it has no parent."""
    repeated = F.when(children > 1, 1).otherwise(0)
    orphans = F.when(parents > 0, 0).otherwise(children)
    return F.when(F.col("test").startswith("unique "), repeated).otherwise(orphans)


def apply_changes(batch: Transaction, *parts: DataFrame) -> dict[str, int]:
    """Bring the counts up to date within a batch and return the failures of every test so far.

    Rows of one value are added up before they are shuffled, so a value may have any share of the rows. They are shuffled once:
    by the key that earlier counts are looked up by, in the tasks that write them. The buckets to read follow from the rows as they come.
    """
    keyed = reduce(DataFrame.unionByName, parts).select(F.concat_ws("\x00", "test", "value").alias("key"), "children", "parents")
    summed = keyed.groupBy("key").agg(F.sum("children").alias("children"), F.sum("parents").alias("parents"))
    test = F.substring_index("key", "\x00", 1)
    summed = summed.filter("children != 0 OR parents != 0").withColumns({"test": test, "value": F.expr("substring(key, instr(key, chr(0)) + 1)")})
    touched = batch.store.touched(keyed.select("key")) if batch.base.tables.get(TABLE) else []
    before = batch.store.read(TABLE, touched, batch.base).select(
        "key", F.col("children").alias("children_before"), F.col("parents").alias("parents_before"))
    was = {c: F.coalesce(f"{c}_before", F.lit(0)) for c in ("children", "parents")}
    now = summed.join(before, "key", "left").select(
        "key", "test", "value", *[(F.col(c) + was[c]).alias(c) for c in was], *[was[c].alias(f"{c}_before") for c in was])
    written = batch.put(TABLE, now, in_place=True)
    more = _failures(F.col("children"), F.col("parents")) - _failures(F.col("children_before"), F.col("parents_before"))
    totals = dict(batch.values.get("failures", {}))
    for test, n in written.groupBy("test").agg(F.sum(more).alias("n")).collect():  # one row per test
        totals[test] = totals.get(test, 0) + n
    batch.values["failures"] = totals
    return totals


def failing(store: Store, at: int | Version | None = None) -> DataFrame:
    """test, value and the number of rows of each value that fails, as the tests on whole tables return them."""
    rows = store.read(TABLE, at=at)
    return rows.filter(_failures(F.col("children"), F.col("parents")) > 0).select("test", "value", F.col("children").alias("n_records"))
