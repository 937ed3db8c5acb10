"""From document JSON to one struct column: ``header``, ``items``, ``summary``."""

from __future__ import annotations

from functools import reduce
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from tallyspark.functions.scalars import json_scalar

if TYPE_CHECKING:
    from tallyspark.sources.registry import Aliases, SourceSpec


def _leaves(section: Aliases) -> StructType:
    return StructType([StructField(name, StringType()) for name in section])


def document_type(spec: SourceSpec) -> StructType:
    return StructType([
        StructField("header", _leaves(spec.header)),
        StructField("items", ArrayType(_leaves(spec.items))),
        StructField("summary", _leaves(spec.summary)),
    ])


def parse_documents(df: DataFrame, json_col: str, spec: SourceSpec, out: str = "document") -> DataFrame:
    """Add the struct column ``out`` with all fields of a document, read in one pass over its text.

    Every leaf is a string or NULL, as a path look-up per field would give. A typed parse differs
    from that in two rare cases: it prints an object or array found at a leaf, and one odd element
    makes it drop the whole item list. Only documents that show such signs are parsed again,
    piece by piece.

    The parsed struct is a column of its own projection. Inside one expression each use of a field
    would become a parse of its own.
    """
    fields = document_type(spec)
    wrapper = spec.root.removeprefix("$").removeprefix(".")
    target = StructType([StructField(wrapper, fields)]) if wrapper else fields
    parsed = df.withColumn("_parsed", F.from_json(F.col(json_col), target))
    document = F.col("_parsed")[wrapper] if wrapper else F.col("_parsed")

    def bracketed(struct: Column, section: Aliases) -> Column:
        tests = [F.coalesce(F.substring(struct[name], 1, 1).isin("{", "["), F.lit(False)) for name in section]
        return reduce(lambda a, b: a | b, tests)

    odd = (
        document["items"].isNull()
        | bracketed(document["header"], spec.header)
        | bracketed(document["summary"], spec.summary)
        | F.exists(document["items"], lambda item: item.isNull() | bracketed(item, spec.items))
    )
    plain = F.struct(*[document[name].alias(name) for name in ("header", "items", "summary")])
    return parsed.withColumn(out, F.when(odd, _parse_piecewise(F.col(json_col), spec)).otherwise(plain)).drop("_parsed")


def _parse_piecewise(raw: Column, spec: SourceSpec) -> Column:
    def section(name: str, fields: Aliases) -> Column:
        return F.struct(*[json_scalar(raw, f"{spec.root}.{name}.{f}").alias(f) for f in fields]).alias(name)

    def item(text: Column, typed: Column) -> Column:
        is_object = F.schema_of_variant(typed).startswith("OBJECT")
        return F.struct(*[F.when(is_object, json_scalar(text, f"$.{f}")).alias(f) for f in spec.items])

    path = f"{spec.root}.items"
    texts = F.from_json(F.get_json_object(raw, path), "array<string>")
    typed = F.try_variant_get(F.try_parse_json(raw), path, "array<variant>")
    items = F.when(typed.isNotNull(), F.zip_with(texts, typed, item)).alias("items")
    return F.struct(section("header", spec.header), items, section("summary", spec.summary))


def resolve_aliases(labels: Column, aliases: list[str] | tuple[str, ...]) -> Column:
    """Value of the first label that is present, even when that value is NULL."""
    first, *rest = aliases
    chain = F.when(F.map_contains_key(labels, first), F.element_at(labels, first))
    for alias in rest:
        chain = chain.when(F.map_contains_key(labels, alias), F.element_at(labels, alias))
    return chain


def with_validity(df: DataFrame, json_col: str, spec: SourceSpec, out: str = "valid") -> DataFrame:
    """Add whether the JSON has the document's shape.

    Header and summary must be objects and items a list of objects; a leaf may be absent, null or text.

    A text is parsed once, in a projection of its own, and each section is read from it by path once. Inside one
    expression each use would become a parse of its own.
    """
    def kind(variant: Column) -> Column:
        return F.coalesce(F.schema_of_variant(variant), F.lit("VOID"))

    def leaves_ok(leaves: Column, section: Aliases) -> Column:
        kinds = [kind(F.try_element_at(leaves, F.lit(name))) for name in section]
        return leaves.isNotNull() & reduce(lambda a, b: a & b, [k.isin("STRING", "VOID") for k in kinds])

    parsed = df.withColumn("_document", F.try_parse_json(F.col(json_col)))
    kinds = {"header": "map<string,variant>", "summary": "map<string,variant>", "items": "array<variant>"}
    sections = {name: F.try_variant_get("_document", f"{spec.root}.{name}", kind) for name, kind in kinds.items()}
    read = parsed.select(*df.columns, *[column.alias(f"_{name}") for name, column in sections.items()])
    rows = F.transform("_items", lambda i: F.try_variant_get(i, "$", "map<string,variant>"))
    valid = (
        leaves_ok(F.col("_header"), spec.header) & leaves_ok(F.col("_summary"), spec.summary)
        & F.col("_items").isNotNull() & F.forall(rows, lambda i: leaves_ok(i, spec.items))
    )
    return read.select(*df.columns, F.coalesce(valid, F.lit(False)).alias(out))


__all__ = ["document_type", "parse_documents", "resolve_aliases", "with_validity"]
