"""Lateral unnesting of a JSON array."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.functions.scalars import json_array


def unnest_items(df: DataFrame, json_col: str, path: str, out: str = "item", pos: str = "pos") -> DataFrame:
    """One row per array element with its position.

    A document whose array is empty, missing or not an array gives no row, like the comma join
    it stands for.
    """
    elements = F.coalesce(json_array(F.col(json_col), path), F.array().cast("array<string>"))
    return df.select("*", F.posexplode(elements).alias(pos, out))
