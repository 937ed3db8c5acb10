"""Near-duplicate lines against comparing all pairs of lines."""

import random
import re

import pytest
from pyspark.sql import functions as F

from tallyspark.llm import line_dedup


def sets_of(text, size=5):
    out = []
    for line in (text or "").split("\n"):
        words = re.findall(r"[^\x20\x09-\x0D]+", line)
        out.append(frozenset(tuple(words[k : k + size]) for k in range(len(words) - size + 1)))
    return out


def brute(rows):
    """Removed line numbers by document; ids are distinct here."""
    lines = [((i is None, i), n, s) for i, t in rows for n, s in enumerate(sets_of(t)) if s]
    lines.sort(key=lambda x: (x[0], x[1]))
    gone = {}
    for k, (i, n, s) in enumerate(lines):
        if any(100 * len(s & o) >= 80 * len(s | o) for _, _, o in lines[:k]):
            gone.setdefault(i[1], []).append(n)
    return {i: gone.get(i, []) for i, _ in rows}


def corpus(seed):
    rnd = random.Random(seed)
    words = [f"w{k}" for k in range(60)]
    bases = [[rnd.choice(words) for _ in range(rnd.choice([3, 5, 6, 12, 30, 60]))] for _ in range(25)]
    shared = " ".join(rnd.choice(words) for _ in range(25))  # a passage within many different lines
    docs = [(100, None), (101, ""), (None, " ".join(bases[4]))]
    for i in range(60):
        lines = []
        for _ in range(rnd.randint(0, 5)):
            line = list(rnd.choice(bases))
            for _ in range(rnd.choice([0, 0, 1, 2])):
                line[rnd.randrange(len(line))] = rnd.choice(words)
            lines.append(rnd.choice([" ", "\t", "  "]).join(line) if rnd.random() < 0.7 else f"{shared} {' '.join(line)}")
        docs.append((i, "\n".join(lines)))
    return docs


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equals_all_pairs(spark, seed):
    rows = corpus(seed)
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, line int").repartition(3)
    got = {r.doc_id: list(r.removed) for r in line_dedup.removals(docs).collect()}
    assert got == brute(rows)


def test_text_that_remains(spark):
    line = "one two three four five six seven"
    rows = [(2, f"{line}\nkept short\n{line}", 3), (1, f"{line} \nThe.", 3), (3, None, 3), (4, line, 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long")
    out = {r.doc_id: (r.text, r.n_chars) for r in line_dedup.remove_lines(docs).collect()}
    assert out == {1: (f"{line} \nThe.", 39), 2: ("kept short", 10), 3: (None, None), 4: ("", 0)}


@pytest.mark.parametrize("rows", [[], [(1, "a b c d e f"), (1, "a b c d e f"), (None, None)]])
def test_empty_and_repeated(spark, rows):
    out = line_dedup.line_report(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert [(r.n_lines, r.n_removed) for r in out] == [(1, 0)] * len(rows)


def test_tables_are_deleted_once_nothing_reads_them(spark, monkeypatch):
    made, gone = [], []
    staged, discard = line_dedup.staged, line_dedup.discard
    monkeypatch.setattr(line_dedup, "staged", lambda df, name: made.append(name) or staged(df, name))
    monkeypatch.setattr(line_dedup, "discard", lambda *tables: gone.extend(tables) or discard(*tables))
    docs = spark.createDataFrame(corpus(4) + corpus(4)[:30], "doc_id long, text string").repartition(3)
    out = line_dedup.line_report(docs)
    assert sorted(made) == sorted(["lines", "classes", "shared", "wanted", "sets", "rarity", "prefixes", "pairs", "found", "pairs", "later", "losing"])
    assert len(gone) == 7 and out.count() == len(corpus(4)) + 30  # all but lines, losing, later and the pairs


def test_tokens_do_not_move_for_repeated_documents(spark, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    docs = spark.createDataFrame([(1, "a b c d e f"), (1, "a b c d e f"), (2, "g h i j k")], "doc_id long, text string")
    wanted = line_dedup._named(docs).selectExpr("xxhash64(doc) AS a", "1 AS b", "doc", "0 AS line").distinct()
    sets = line_dedup._sets(docs, wanted, 5)
    plan = sets._jdf.queryExecution().executedPlan().toString()
    assert sorted(len(r.tokens) for r in sets.collect()) == [1, 2]
    assert not [line for line in plan.split("\n") if "Exchange hashpartitioning(a" in line and "tokens" in line]


def family(rnd, copies=120):
    """Lines that differ from one base in 3 of 100 words each: none is similar to another."""
    base = [f"w{k}" for k in range(100)]
    rows = []
    for i in range(copies):
        line = list(base)
        for k in rnd.sample(range(5, 95, 6), 3):
            line[k] = f"v{i}k{k}"
        rows.append((i, " ".join(line)))
    return rows


def test_lines_of_a_family_are_not_all_verified(spark, monkeypatch):
    """They share rare tokens, but bitmaps of the sets tell most of them apart before a pair is made."""
    made = {}
    staged = line_dedup.staged
    monkeypatch.setattr(line_dedup, "staged", lambda df, name: made.setdefault(name, []).append(out := staged(df, name)) or out)
    rows = family(random.Random(8))
    got = {r.doc_id: list(r.removed) for r in line_dedup.removals(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute(rows)
    assert sum(t.count() for t in made["pairs"]) < 120 * 119 / 2 / 10


def test_head_shows_enough_common_tokens(spark):
    """Of two similar sets each has as many tokens of its head in the other's head as is asked for."""
    for percent in (50, 80, 100):
        frame = spark.range(1, 400).select(F.col("id").alias("n"), line_dedup._least(F.col("id"), percent).alias("least"), line_dedup._met(F.col("id"), percent).alias("met"))
        by = {r.n: (r.least, r.met) for r in frame.collect()}
        for n, (least, met) in by.items():
            assert 1 <= met <= least  # that many are in common, and in the head of least common tokens
            for n2 in range(least, n + 1):
                common = max(by[n][0], by[n2][0])
                assert min(by[n][1], by[n2][1], common) >= by[least][1]


def test_blanks_of_all_kinds_part_words(spark):
    rows = [(1, "a b c d e f g"), (2, "a\tb\x0bc\x0cd\re  f g "), (3, "a b c d e f g"), (4, "a b c d\x85e f g")]
    got = {r.doc_id: list(r.removed) for r in line_dedup.removals(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute(rows) == {1: [], 2: [0], 3: [], 4: []}


def test_a_document_is_cut_once_for_its_lines(spark):
    docs = spark.createDataFrame([(1, "a b c d e f\ng h i j k")], "doc_id long, text string")
    plan = line_dedup._lines(docs, 5, 80)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(replace(") == 1
