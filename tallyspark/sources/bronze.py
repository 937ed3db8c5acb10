"""Rows of the append-only bronze tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.functions.scalars import file_name
from tallyspark.schemas import BRONZE
from tallyspark.sources.registry import SourceSpec


def replay_safe_id(source_id: int) -> Column:
    """The same file version always gets the same id, so a repeated batch adds nothing new."""
    modified = F.unix_micros("modificationTime").cast("string")
    return F.sha2(F.concat_ws("|", F.lit(str(source_id)), F.col("path"), modified), 256)


def bronze_envelope(extracted: DataFrame, spec: SourceSpec, now: Column | None = None,
                    unwrap_json_string: bool = False) -> DataFrame:
    """Wrap extracted JSON as bronze rows: id, document, time, exclusion mark, file name.

    A raw text taken in place of a document is stored as a JSON string, which no path resolves in.
    With ``unwrap_json_string``, text that is itself a JSON document is stored as that document.
    """
    document = F.col("json")
    if unwrap_json_string:
        inner = F.try_variant_get(F.try_parse_json(document), "$", "string")
        is_text = F.schema_of_variant(F.try_parse_json(document)) == "STRING"
        document = F.when(is_text & F.try_parse_json(inner).isNotNull(), inner).otherwise(document)
    return extracted.select(
        replay_safe_id(spec.source_id).alias("id"),
        document.alias("raw_json"),
        (F.current_timestamp() if now is None else now).alias("inserted_at"),
        F.lit(False).alias("exclude_from_silver"),
        file_name(F.col("path")).alias("file_name_in_R2"),
    ).select(*BRONZE.names)
