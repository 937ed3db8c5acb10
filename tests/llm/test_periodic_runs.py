"""Runs against a search that tries every period at every place."""

import hashlib
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyspark.llm import periodic_runs as pr
from tallyspark.llm.queries import QUERIES, table

SF = "/root/testdata/sf0.001"


def brute(words):
    """(start, length, period) of all runs, straight from the definition."""
    found = {}
    n = len(words)
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            s = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            if i + q - s >= max(12, 2 * q):
                found.setdefault((s, i + q - s), q)
    return sorted((s, length, q) for (s, length), q in found.items())


def expected(doc_id, text):
    """The row of the report, from the text of the contract."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    g = h // 10
    if doc_id is not None and h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = sorted(brute(words), key=lambda r: (r[0], r[2]))
    drop = {i for s, length, q in runs for i in range(s + q, s + length)}
    top = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    kept = " ".join(w for i, w in enumerate(words) if i not in drop)
    return (doc_id, len(runs), top[0], top[1], top[2], 1000 * top[1] // top[2] if runs else None,
            hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def numbered(texts):
    sizes = np.array([len(t) for t in texts], np.int64)
    out = [[] for _ in texts]
    for n, s, length, q in zip(*pr.find_runs(np.array([w for t in texts for w in t], np.int64), sizes), strict=True):
        out[n].append((int(s), int(length), int(q)))
    return out


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=70), min_size=1, max_size=4))
def test_runs_equal_brute_force(texts):
    assert numbered(texts) == [brute(t) for t in texts]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 4), min_size=1, max_size=15), st.integers(1, 12)), min_size=1, max_size=8))
def test_repeated_parts_equal_brute_force(parts):
    text = [w for part, times in parts for w in part * times]
    assert numbered([text, text]) == [brute(text)] * 2


def test_extensions():
    rng = np.random.default_rng(1)
    words = np.append(np.tile(rng.integers(0, 3, 17), 20)[:300], 9)
    words[150] = 7
    i, j = (a.ravel() for a in np.meshgrid(np.arange(300), np.arange(300)))
    i, j = i[i < j], j[i < j]
    got = pr.Extensions(words).lengths(i, j)
    for a, b, length in zip(i[::37], j[::37], got[::37], strict=True):
        alike = 0
        while b + alike < len(words) and words[a + alike] == words[b + alike]:
            alike += 1
        assert alike == length


def test_cover_reaches_every_difference():
    assert {(a - b) % pr.MODULUS for a in pr.COVER for b in pr.COVER} == set(range(pr.MODULUS))


def test_report_equals_contract(spark):
    docs = table(spark, SF, "documents")
    got = sorted(map(tuple, QUERIES["op12_periodic_runs"](spark, SF).collect()))
    assert got == sorted(expected(r.doc_id, r.text) for r in docs.collect())
    assert sum(r[1] > 0 for r in got) > 10


def test_odd_rows(spark):
    rows = [(None, "a b " * 9), (1, None), (2, ""), (3, " \t\n\x0b\x0c\r "), (4, "x " * 500), (4, "x " * 500), (30, "one two"),
            (5, "é é " * 8), (6, "a b c d e f " * 2 + "g"), (10, "w " * 11), (11, "w " * 12)]
    docs = spark.createDataFrame([(i, t, 0, []) for i, t in rows], "doc_id long, text string, n_words int, runs array<int>")
    got = pr.run_report(pr.planted(docs)).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(str(expected(i, t)) for i, t in rows)
    assert pr.run_report(pr.planted(docs.limit(0))).collect() == []


def test_operator_gives_runs_and_texts(spark):
    docs = spark.createDataFrame([(1, "so say we all " * 4 + "end")], "doc_id long, text string")
    row = pr.periodic_runs(docs).first()
    assert (row.n_words, [tuple(r) for r in row.runs], row.collapsed) == (17, [(0, 16, 4)], "so say we all end")


@pytest.mark.parametrize("text", [["w"] * 40_000, ["a", "b", "c"] * 13_000, list(map(str, range(30_000))) * 2])
def test_very_long_texts(text):
    number = {}
    words = np.array([number.setdefault(w, len(number)) for w in text], np.int64)
    runs = list(zip(*pr.find_runs(words, np.array([len(words)])), strict=True))
    assert runs == [(0, 0, len(text), len(number))]
