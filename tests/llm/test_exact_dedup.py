"""Exact copies against grouping by hand, within a batch and across batches."""

import hashlib
import random
import re

import pytest

from tallyspark.llm.exact_dedup import DigestIndex, exact_dedup
from tallyspark.session import durable_path

SCHEMA = "doc_id long, text string, digest string, kept int"


def brute(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t or ""), []).append((-len(t or ""), i is None, i))
    out = []
    for i, t in rows:
        n = re.sub(r"[\x20\x09-\x0D]", "", t or "")
        keep = min(groups[n], key=lambda g: (g[0], g[1], g[2] or 0))[2]
        out.append((i, keep, len(groups[n]), i == keep, hashlib.sha256(n.encode()).hexdigest()))
    return sorted(out, key=repr)


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)


def collected(df):
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in df.collect()), key=repr)


def test_equals_grouping(spark):
    rnd = random.Random(1)
    rows = [(i, rnd.choice([None, "", " ", "a b", "ab", "a\tb\n", "a b", "é", "x" * rnd.randint(1, 4)])) for i in range(400)]
    assert collected(exact_dedup(table(spark, rows))) == brute(rows)


@pytest.mark.parametrize("rows", [[], [(None, "a"), (None, "a"), (3, "a"), (3, "a")], [(None, None)]])
def test_empty_null_and_repeated(spark, rows):
    assert collected(exact_dedup(table(spark, rows))) == brute(rows)


def test_batches(spark):
    path = durable_path(spark, "index")
    first = [(1, "a"), (2, "b"), (3, "a ")]
    second = [(4, "b"), (5, "c"), (6, "c")]
    index = DigestIndex(spark, path, buckets=3)
    assert [r[:2] for r in collected(index.deduplicate(table(spark, first), "1"))] == [(1, 3), (2, 2), (3, 3)]
    again = DigestIndex(spark, path, buckets=3)  # opened by path
    one = collected(again.deduplicate(table(spark, second), "2"))
    assert [(r[0], r[1], r[3]) for r in one] == [(4, 2, False), (5, 5, True), (6, 5, False)]
    assert collected(again.deduplicate(table(spark, second), "2")) == one
    assert again.rows().count() == 3


def test_history_is_not_shuffled(spark, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    index = DigestIndex(spark, durable_path(spark, "index"), buckets=4)
    index.deduplicate(table(spark, [(1, "a")]), "1")
    groups = table(spark, [(2, "b")]).selectExpr("unhex(sha2(text, 256)) AS digest").groupBy("digest").count()
    plan = groups.join(index.rows().select("digest").hint("merge"), "digest", "left_anti")._jdf.queryExecution().executedPlan().toString()
    scan = plan.split("SortMergeJoin")[1].split("FileScan")[-1]
    assert "SelectedBucketsCount: 4 out of 4" in scan and plan.count("Exchange") <= 2
