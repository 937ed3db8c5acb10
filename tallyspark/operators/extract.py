"""Schema-guided extraction on executors."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Iterator, Mapping
from dataclasses import dataclass
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyspark.operators.dedup import latest_per_key
from tallyspark.schemas import EXTRACTED
from tallyspark.sources.registry import SourceSpec


class Extractor(Protocol):
    """Turns one document into ``{section: labels}``; ``items`` holds a list of label maps.

    Of a document of several pages it may return a list with an entry a page, in order: ``{"extracted_data": sections or
    None, "raw_text": text or None}``. Built once per task by its factory and closed when the task ends.
    """

    def extract(self, content: bytes) -> dict | list[dict] | None: ...

    def close(self) -> None: ...


@dataclass(frozen=True)
class HtmlColumns:
    """Reads labelled fields from a page with Spark's own functions: one pattern with one group per label, by section.

    No model and no Python worker is needed. A page that does not end in ``</html>`` was cut off and is refused, and so
    is one that is not UTF-8.
    """

    labels: Mapping[str, Mapping[str, str]]

    def error(self, content: Column) -> Column:
        text = content.cast("string")
        return F.when(~F.is_valid_utf8(text), F.lit("UnicodeDecodeError: not UTF-8")).when(
            ~F.endswith(text, F.lit("</html>")), F.lit("ValueError: truncated document"))

    def document(self, content: Column, spec: SourceSpec) -> Column:
        text = content.cast("string")

        def fields(section: str) -> Column:
            printed = self.labels.get(section, {})
            found = []
            for name, aliases in spec.sections[section].items():
                value = F.lit(None).cast("string")
                for label in reversed([a for a in aliases if a in printed]):
                    value = F.when(F.rlike(text, F.lit(printed[label])), F.regexp_extract(text, printed[label], 1)).otherwise(value)
                found.append(value.alias(name))
            return F.struct(*found)

        body = F.struct(fields("header").alias("header"), F.array(fields("items")).alias("items"), fields("summary").alias("summary"))
        for part in reversed(spec.root.split(".")[1:]):
            body = F.struct(body.alias(part))
        return F.to_json(body, {"ignoreNullFields": "false"})


def _pick(labels: dict, aliases: tuple[str, ...]) -> str | None:
    return next((labels[a] for a in aliases if a in labels), None)


def _document(sections: dict, spec: SourceSpec) -> str:
    """Named fields from printed labels: the row-level twin of ``resolve_aliases``."""
    def named(name: str, labels: dict) -> dict:
        return {field: _pick(labels, aliases) for field, aliases in spec.sections[name].items()}

    body = {
        "header": named("header", sections["header"]),
        "items": [named("items", labels) for labels in sections["items"]],
        "summary": named("summary", sections["summary"]),
    }
    for part in reversed(spec.root.split(".")[1:]):
        body = {part: body}
    return json.dumps(body, ensure_ascii=False)


def extract_documents(files: DataFrame, spec: SourceSpec, extractor: Callable[[], Extractor] | HtmlColumns, *kept: str) -> DataFrame:
    """``path, modificationTime, json, error, pages`` for each file, and the columns named in ``kept``.

    A failing document gets an error and the rest go on. ``json`` is what ``payload`` makes of the pages. An extractor
    given as columns stays in the plan. A model runs in tasks over Arrow batches: partitions hold many documents, so a
    costly one is set up once per task. Keep ``spark.sql.execution.arrow.maxRecordsPerBatch`` low enough for a batch of
    documents to fit a Python worker.
    """
    rows = files.select("path", "modificationTime", "content", *kept)
    if isinstance(extractor, HtmlColumns):
        error = extractor.error(F.col("content"))
        page = F.struct(extractor.document(F.col("content"), spec).alias("extracted_data"), F.lit(None).cast("string").alias("raw_text"))
        read = rows.select("path", "modificationTime", error.alias("error"), "content", *kept).select(
            "path", "modificationTime", "error", F.when(F.col("error").isNull(), F.array(page)).alias("pages"), *kept)
    else:
        fields = [*(f for f in EXTRACTED.fields if f.name != "json"), *(files.schema[n] for n in kept)]
        read = rows.mapInPandas(_run_model(extractor, spec, kept), StructType(fields))
    return read.withColumn("json", payload(F.col("pages"))).select(*EXTRACTED.names, *kept)


def _run_model(extractor: Callable[[], Extractor], spec: SourceSpec, kept: Iterable[str] = ()) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = extractor()

        def one(content: bytes) -> tuple[list[dict] | None, str | None]:
            try:
                result = model.extract(content)
                if result is None:
                    return None, None
                found = result if isinstance(result, list) else [{"extracted_data": result}]
                return [{"extracted_data": _document(p["extracted_data"], spec) if p.get("extracted_data") else None, "raw_text": p.get("raw_text")}
                        for p in found], None
            except Exception as failure:  # isolated to this document, reported in its row
                return None, f"{type(failure).__name__}: {failure}"

        try:
            for batch in batches:
                results = [one(content) for content in batch["content"]]
                yield pd.DataFrame({
                    "path": batch["path"],
                    "modificationTime": batch["modificationTime"],
                    "error": pd.Series([r[1] for r in results], index=batch.index, dtype=object),
                    "pages": pd.Series([r[0] for r in results], index=batch.index, dtype=object),
                    **{name: batch[name] for name in kept},
                })
        finally:
            model.close()

    return run


def accepted(extracted: DataFrame) -> DataFrame:
    return extracted.filter(F.col("error").isNull() & F.col("json").isNotNull())


def quarantined(extracted: DataFrame) -> DataFrame:
    """Failed and empty results with the outcome the ledger records for them."""
    return extracted.filter(F.col("error").isNotNull() | F.col("json").isNull()).withColumn(
        "outcome", F.lit("failed_retryable")
    )


def payload(pages: Column) -> Column:
    """The document that is stored for all pages: the first page's data, else its raw text as a JSON string."""
    first = F.get(pages, F.lit(0))
    quoted = F.to_json(F.array(first["raw_text"]))
    text = F.when(first["raw_text"].isNotNull(), F.substring(quoted, F.lit(2), F.length(quoted) - 2))
    return F.coalesce(first["extracted_data"], text)


def page_payload(pages: Column) -> Column:
    """What the first page of a result yields: its extracted data, else its raw text."""
    first = F.get(pages, F.lit(0))
    return F.coalesce(first["extracted_data"], first["raw_text"])


def first_page(df: DataFrame, document: str, pages: list[str]) -> DataFrame:
    """The first page of each document in the order of the ``pages`` columns."""
    return latest_per_key(df, [document], pages)
