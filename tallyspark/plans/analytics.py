"""The dashboard's datasets. Each is one plan over the gold tables or the semantic model."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.functions import (
    iso_weekday,
    money_text,
    month_abbr,
    normalise_text,
    other_bucket,
    weekday_name,
)
from tallyspark.functions.dates import MONTHS


def semantic_model(fact: DataFrame, buyer: DataFrame | None = None, vendor: DataFrame | None = None) -> DataFrame:
    """The five columns the dashboard filters and sums, without the names of a dimension that is left out.

    A dataset that neither shows nor filters by a dimension gives the same result without it, for
    its keys are unique. Dimensions may be too large to broadcast, so no hint is given: Spark compares
    their size with its broadcast limit, and AQE splits a buyer or vendor that holds most lines.
    """
    lines, names = fact.select("invoice_date", "spend", "item_qty", "buyer_no_id", "vendor_no_id"), []
    for name, dimension in (("buyer", buyer), ("vendor", vendor)):
        if dimension is not None:
            lines = lines.join(dimension.select(f"{name}_no_id", f"{name}_desc"), f"{name}_no_id", "left")
            names.append(f"{name}_desc")
    return lines.select("invoice_date", "spend", "item_qty", *names)


def semantic_filter(
    df: DataFrame,
    vendors: Sequence[str] = (),
    buyers: Sequence[str] = (),
    dates: Sequence[date | str] | None = None,
) -> DataFrame:
    """The global filters. An empty selection does not filter, nor does a date range with one end.

    The dashboard always sets both ends (by default to ``date_bounds``), which drops lines
    without a date.
    """
    if vendors:
        df = df.filter(F.col("vendor_desc").isin(*vendors))
    if buyers:
        df = df.filter(F.col("buyer_desc").isin(*buyers))
    if dates is not None and len(dates) == 2:
        first, last = (F.lit(d).cast("date") for d in dates)
        df = df.filter(F.col("invoice_date").between(first, last))
    return df


def _sum_or_zero(column: str) -> Column:
    """Frame sums of nothing are 0; Spark's are NULL."""
    return F.coalesce(F.sum(column), F.lit(0))


def _money(column: str) -> tuple[Column, Column]:
    """Sum of amounts as a decimal, and the sum of the values that are none (NaN, above 10^22) as a float.

    Spend has three places. Sums of floats lose some of them, more with every line and differently with every order.
    """
    amount = F.col(column).try_cast("decimal(28,6)")
    return F.coalesce(F.sum(amount), F.lit(0).cast("decimal(38,6)")), F.sum(F.when(amount.isNull(), F.col(column)))


def _spend_or_zero() -> Column:
    exact, rest = _money("spend")
    return exact.cast("double") + F.coalesce(rest, F.lit(0.0))


def kpi_totals(df: DataFrame) -> DataFrame:
    return df.agg(
        _spend_or_zero().alias("total_spend"),
        _sum_or_zero("item_qty").alias("total_qty"),
        F.count(F.lit(1)).alias("records"),
    )


def kpi_formatted(df: DataFrame) -> DataFrame:
    """The totals as text. Cents are those of the decimal sum: a float has none left above some 10^14."""
    exact, rest = _money("spend")
    totals = df.agg(exact.alias("exact"), rest.alias("rest"), _sum_or_zero("item_qty").alias("total_qty"), F.count(F.lit(1)).alias("records"))
    return totals.select(
        F.when(F.col("rest").isNull(), money_text(F.round("exact", 2))).otherwise(
            money_text(F.col("exact").cast("double") + F.col("rest"))).alias("total_spend"),
        F.format_number("total_qty", 0).alias("total_qty"),
        F.format_number("records", 0).alias("records"),
    )


def spend_by_date(df: DataFrame) -> DataFrame:
    return df.groupBy("invoice_date").agg(_spend_or_zero().alias("spend")).orderBy("invoice_date")


def spend_treemap(df: DataFrame) -> DataFrame:
    """Spend per vendor and buyer, per vendor, and in total; ``level`` is 2, 1 and 0."""
    totals = df.rollup("vendor_desc", "buyer_desc").agg(
        _spend_or_zero().alias("spend"), F.grouping_id().alias("_grouped")
    )
    level = F.when(F.col("_grouped") == 0, 2).when(F.col("_grouped") == 1, 1).otherwise(0)
    return totals.select("vendor_desc", "buyer_desc", level.alias("level"), "spend")


def spend_share(df: DataFrame, by: str) -> DataFrame:
    """Spend and its share of the total per vendor or buyer, small lines gathered as ``Other``.

    The bucket is chosen line by line, before summing.
    """
    name = other_bucket(F.col("spend"), F.col(by)).alias(by)
    sums = df.select(name, "spend").groupBy(by).agg(_spend_or_zero().alias("spend"))
    total = sums.agg(F.sum("spend")).scalar()
    return sums.select(by, "spend", (F.col("spend") / F.nullif(total, F.lit(0.0))).alias("share"))


def frequent_items(fact: DataFrame) -> DataFrame:
    """Normalised descriptions that occur on more than one line, sorted."""
    raw = fact.groupBy("item_desc").agg(F.count(F.lit(1)).alias("n"))  # each spelling is normalised once
    return (
        raw.groupBy(normalise_text(F.col("item_desc")).alias("cleaned_desc"))
        .agg(F.sum("n").alias("n"))
        .filter("n > 1")
        .select("cleaned_desc")
        .orderBy("cleaned_desc")
    )


def item_evolution(fact: DataFrame, item: str) -> DataFrame:
    """Quantity and spend of one normalised item by date; a date with only NULLs stays NULL.

    A description without the item's longest word is turned away before it is normalised.
    """
    word = max(item.split(" "), key=len)
    same = F.contains(F.replace("item_desc", F.lit(","), F.lit("")), F.lit(word)) & (normalise_text(F.col("item_desc")) == F.lit(item))
    return (
        fact.filter(same).groupBy("invoice_date")
        .agg(F.sum("item_qty").alias("total_qty"), F.sum("spend").alias("total_spend"))
        .orderBy("invoice_date")
    )


def heatmap_counts(df: DataFrame) -> DataFrame:
    """Number of lines per month name and weekday, all years together.

    Lines are counted per date first: few dates exist, so their names are formatted once each.
    """
    per_date = df.groupBy("invoice_date").agg(F.count(F.lit(1)).alias("n"))
    day = F.col("invoice_date")
    named = per_date.select(
        month_abbr(day).alias("month"), weekday_name(day).alias("weekday"), iso_weekday(day).alias("weekday_num"), "n"
    )
    return (
        named.groupBy("month", "weekday", "weekday_num").agg(F.sum("n").alias("invoice_count")).orderBy("weekday_num")
    )


def heatmap_pivot(df: DataFrame, drop_empty: bool = False) -> DataFrame:
    """Weekday by month in calendar order, 0 where nothing was counted.

    All twelve months are columns; ``drop_empty`` removes those without any line, which takes
    one look at the counted result. Lines without a date have no cell.
    """
    counts = heatmap_counts(df).filter(F.col("weekday_num").isNotNull())
    table = counts.groupBy("weekday_num", "weekday").pivot("month", MONTHS).agg(F.sum("invoice_count"))
    if drop_empty:
        used = table.agg(*[F.count(m).alias(m) for m in MONTHS]).first()
        table = table.drop(*[m for m in MONTHS if not used[m]])
    return table.na.fill(0).orderBy("weekday_num")


def filter_options(fact: DataFrame, dimension: DataFrame, name: str) -> DataFrame:
    """Distinct names of the buyers or vendors on lines, NULL first. Keys are made distinct before they meet names."""
    keys = fact.select(f"{name}_no_id").distinct()
    names = dimension.select(f"{name}_no_id", f"{name}_desc")
    return keys.join(names, f"{name}_no_id", "left").select(f"{name}_desc").distinct().orderBy(f"{name}_desc")


def date_bounds(df: DataFrame) -> DataFrame:
    return df.agg(F.min("invoice_date").alias("min_date"), F.max("invoice_date").alias("max_date"))
