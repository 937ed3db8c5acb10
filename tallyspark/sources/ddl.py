"""Databases and tables in the catalog, and publishing a new version of one."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.types import StructType

from tallyspark.schemas import TABLES


def create_schema(spark: SparkSession, name: str, location: str | None = None) -> None:
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{where}")


def create_table(spark: SparkSession, name: str, schema: StructType, location: str) -> None:
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet LOCATION '{location}'")


def create_all(spark: SparkSession, root: str, suffix: str = "") -> list[str]:
    """Create the databases and tables of the model below ``root``; existing ones stay as they are.

    ``suffix`` is added to database names, to keep several environments in one catalog.
    """
    names = []
    for table, schema in TABLES.items():
        database, short = table.split(".")
        create_schema(spark, database + suffix, f"{root}/{database}{suffix}")
        create_table(spark, f"{database}{suffix}.{short}", schema, f"{root}/{database}{suffix}/{short}")
        names.append(f"{database}{suffix}.{short}")
    return names


def publish_table(spark: SparkSession, name: str, schema: StructType, path: str) -> None:
    """Let the table show the rows already written to ``path``.

    Readers see the old rows until this one catalog change.
    """
    create_table(spark, name, schema, path)
    spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
    spark.catalog.refreshTable(name)
