"""Registered queries against their SQL, and the stages of the pipeline on small tables."""

from pathlib import Path

import pytest

import corpus_pipeline
from tallyspark.llm.queries import ORACLES, QUERIES
from tallyspark.llm.toxicity import Network
from workload.check import canonical, connect

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="needs the test tables")


@pytest.mark.parametrize("name", ORACLES)
def test_query_equals_sql(spark, name):
    result, sql = QUERIES[name](spark, SF), connect(SF).execute(ORACLES[name])
    names = [d[0] for d in sql.description]
    assert sorted(result.columns) == sorted(names)
    assert canonical(result.columns, result.collect()) == canonical(names, sql.fetchall())


def test_pipeline(spark, monkeypatch):
    """Each stage keeps rows of the stage before, with the columns of documents; what goes has a reason."""
    monkeypatch.setattr(corpus_pipeline.toxicity, "fit", lambda *a: Network.new(1))
    seen = []
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before = docs.columns, {r.doc_id for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.staged(stage(spark, docs, SF), name)
        assert docs.columns == columns
        now = [r.doc_id for r in docs.collect()]
        assert len(now) == len(set(now)) and set(now) <= before and now
        seen.append((name, len(before), len(now)))
        before = set(now)
    name, stage = corpus_pipeline.STAGES[-1]
    pieces = stage(spark, docs, SF).collect()
    assert {r.doc_id for r in pieces} == before
    assert seen[1][1] == seen[1][2]  # line dedup keeps all documents
