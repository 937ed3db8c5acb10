"""The registered queries of the operators and the SQL they must equal, where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallyspark.llm import (
    alignment, decontaminate, exact_dedup, html_text, line_dedup, near_dedup, packing, periodic_runs, secrets, surrogates, token_counts, toxicity,
    url_filter,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str) -> str:
    """A public tokenizer file; its folder is on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), end_id=2)


@query
def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents"))


@query
def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


@query
def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


ORACLES["op7_exact_dedup"] = exact_dedup.ORACLE


@query
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


@query
def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


@query
def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), size=3, percent=85)


@query
def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLES["op5_decontamination"] = decontaminate.ORACLE


@query
def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_report(table(spark, sf_dir, "documents"))


ORACLES["op3_line_dedup"] = line_dedup.ORACLE


@query
def op6_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return surrogates.replace(table(spark, sf_dir, "documents"), key=b"example key of the registered query")


@query
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.run_report(periodic_runs.planted(table(spark, sf_dir, "documents")))


#: Fixed values of the query.
URL_RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))


@query
def op13_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return url_filter.judge(pages, url_filter.outcomes_of(pages, table(spark, sf_dir, "labels")), URL_RULES)


@query
def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.link_report(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model"))
