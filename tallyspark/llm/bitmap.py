"""A bounded bitmap of the values of one table, to turn away rows of another before a join moves them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORDS = 1 << 18  # words of a bitmap, 4 MB with their numbers


def likely(rows: DataFrame, wanted: DataFrame, column: str) -> DataFrame:
    """All rows whose ``column`` is in that of ``wanted``, and few others: a join that follows is exact.

    The bitmap has ``WORDS`` words at most, whatever the number of values, so it can be broadcast.
    """
    bitmap = wanted.groupBy(_word(column).alias("word")).agg(F.bit_or(_bit(column)).alias("bits"))
    met = rows.join(F.broadcast(bitmap), _word(column) == F.col("word"))
    return met.where(F.col("bits").bitwiseAND(_bit(column)) != 0).select(*rows.columns)


def _word(column: str) -> Column:
    return F.pmod(F.shiftright(F.xxhash64(column), 6), F.lit(WORDS))


def _bit(column: str) -> Column:
    return F.expr(f"shiftleft(1L, CAST(xxhash64(`{column}`) & 63 AS INT))")
