"""Handing results over."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE_FILES = 70  # fixed value


MAX_ROWS = 100_000  # more than any chart shows


def to_columns(result: DataFrame, max_rows: int = MAX_ROWS) -> pa.Table:
    """An aggregated result as an Arrow table. A result of more than ``max_rows`` rows is refused, never cut."""
    rows = result.limit(max_rows + 1).toArrow()
    if rows.num_rows > max_rows:
        raise ValueError(f"the result has more than {max_rows} rows; write it to a table instead")
    return rows


def sample_by_path(files: DataFrame, n: int = SAMPLE_FILES, path: Column | None = None) -> DataFrame:
    """The first ``n`` files by path, for comparing extracted fields with the truth by hand."""
    return files.orderBy(F.col("path") if path is None else path).limit(n)
