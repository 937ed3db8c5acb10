"""Latest version per key."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def sort_columns(order: list[str]) -> list[Column]:
    """Column names to sort columns; a leading ``-`` sorts descending. NULLs are lowest."""
    return [F.col(o[1:]).desc() if o.startswith("-") else F.col(o).asc() for o in order]


def latest_per_key(df: DataFrame, keys: list[str], order: list[str], ties: str = "one") -> DataFrame:
    """Keep the first row of each key in the given order.

    ``order`` must be total for a repeatable result. Spark turns ``row_number() = 1`` into a
    group limit on both sides of the shuffle, so a task sends at most one row per key and a key
    holding a third of all rows costs its reducer one row per map task.

    ``ties="all"`` keeps every row that ties with the first one. Any number may tie, so they are
    not ranked in one window: the best order values are found as above and the rows joined to
    them, a join that AQE splits where one key is hot.
    """
    if ties not in ("one", "all"):
        raise ValueError(f"ties must be 'one' or 'all', not {ties!r}")
    if ties == "all":
        columns = [*keys, *[o.removeprefix("-") for o in order]]
        best = latest_per_key(df.select(*columns), keys, order)
        best = best.toDF(*[f"_best_{c}" for c in columns])
        same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_best_{c}")) for c in columns])
        return df.join(best, same, "left_semi")
    ranked = Window.partitionBy(*keys).orderBy(*sort_columns(order))
    return df.withColumn("_rank", F.row_number().over(ranked)).filter("_rank = 1").drop("_rank")
