"""Merge by key: matched rows are replaced, others inserted, nothing deleted."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, StructType, VariantType

from tallyspark.operators.versioned import DuplicateKeyError, Store, TableSpec

__all__ = ["DuplicateKeyError", "read_table", "upsert", "upsert_table"]

TABLE = "rows"


def upsert(target: DataFrame | None, source: DataFrame, key: str) -> DataFrame:
    """The merged rows. The first run, without a target, is the source itself.

    A NULL key matches nothing, so both sides keep such rows. A key that the target has and the source has more
    than once fails the job that reads the result; duplicates among new keys are inserted as they are, for picking
    one would hide a key conflict.

    Both sides are scanned once and meet in one shuffle by key, in which source rows are counted. Rows with a NULL
    key are spread by their content.
    """
    if target is None:
        return source
    both = target.withColumn("_new", F.lit(0)).unionByName(source.withColumn("_new", F.lit(1)))
    plain = [F.col(f.name) for f in target.schema.fields if not isinstance(f.dataType, MapType | VariantType)]
    per_key = Window.partitionBy(key, F.when(F.col(key).isNull(), F.xxhash64(*plain)))
    counted = both.withColumns({"_in_source": F.sum("_new").over(per_key), "_in_target": F.sum(1 - F.col("_new")).over(per_key)})
    conflict = F.col(key).isNotNull() & (F.col("_in_source") > 1) & (F.col("_in_target") > 0)
    message = F.concat(F.lit(f"DuplicateKeyError: {key} = "), F.col(key).cast("string"), F.lit(" occurs more than once in the batch and in the target"))
    kept = (F.col("_new") == 1) | (F.col("_in_source") == 0) | F.col(key).isNull()
    return counted.filter(F.when(conflict, F.raise_error(message).cast("boolean")).otherwise(kept)).select(*target.columns)


def _store(spark: SparkSession, path: str, schema: StructType, key: str, buckets: int) -> Store:
    return Store(spark, path, {TABLE: TableSpec(schema, key)}, buckets)


def read_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame | None:
    """Rows of a table kept by ``upsert_table``.

    The schema is given, as a table may have been created by a batch without rows.
    """
    version = _store(spark, path, schema, "", 1).version()
    return _store(spark, path, schema, version.values["key"], 1).read(TABLE, at=version) if version.number else None


def upsert_table(spark: SparkSession, path: str, source: DataFrame, key: str, buckets: int = 256) -> None:
    """Merge ``source`` into the table at ``path``, in one version of it.

    The batch is appended and the next version names it: what a batch writes is the batch, and now and then some
    earlier ones put together. A replayed batch replaces its own rows by the same rows.
    """
    store = _store(spark, path, source.schema, key, buckets)
    batch = store.transaction()
    try:
        batch.put(TABLE, source, check_keys=True, in_place=True)
    except DuplicateKeyError:
        batch.drop()
        raise
    batch.values["key"] = key
    batch.commit()
    store.compact()
