"""Calendar parts as the dashboard shows them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Calendar order of the heatmap axes.
MONTHS = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]


def month_abbr(date: Column) -> Column:
    return F.date_format(date, "MMM")


def weekday_name(date: Column) -> Column:
    return F.date_format(date, "EEEE")


def iso_weekday(date: Column) -> Column:
    """1 for Monday to 7 for Sunday."""
    return F.weekday(date) + 1
