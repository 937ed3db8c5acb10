"""DataFrame operators: unnesting, deduplication, upsert, extraction and data checks."""

from tallyspark.operators.dedup import latest_per_key
from tallyspark.operators.unnest import unnest_items
from tallyspark.operators.upsert import DuplicateKeyError, read_table, upsert, upsert_table
from tallyspark.operators.versioned import Store, TableSpec

__all__ = ["DuplicateKeyError", "Store", "TableSpec", "latest_per_key", "read_table", "unnest_items", "upsert", "upsert_table"]
