"""Contamination against a scan of all positions."""

import hashlib
import random
import re

import pytest

from tallyspark.llm import decontaminate


def cut(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items):
    windows = {}
    for i, text in items:
        w = cut(text)
        for s in range(max(1, len(w) - 9) if w else 0):
            windows.setdefault(tuple(w[s : s + 10]), set()).add(i)
    out = []
    for d, text in docs:
        w, hit, found = cut(text), set(), set()
        for n in {len(x) for x in windows}:
            for s in range(len(w) - n + 1):
                if (own := windows.get(tuple(w[s : s + n]))) is not None:
                    hit |= set(range(s, s + n))
                    found |= own
        ids = sorted(str(i) for i in found if i is not None)
        out.append((d, len(w), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


def run(spark, docs, items):
    d = spark.createDataFrame([(*r, "x") for r in docs], "doc_id long, text string, words string").repartition(3)
    i = spark.createDataFrame([(*r, 1) for r in items], "item_id long, text string, doc int")
    return sorted((tuple(r[c] for c in ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")) for r in decontaminate.contamination(d, i).collect()), key=repr)


def data():
    rnd = random.Random(4)
    words = [f"w{k}" for k in range(30)] + ["É", "ñ1", "日本"]
    items = [(i, " ".join(rnd.choice(words) for _ in range(n))) for i, n in enumerate([1, 2, 3, 5, 9, 10, 11, 25, 40])] + [(20, None), (21, ""), (22, "--")]
    items += [(23, items[8][1]), (None, items[7][1])]
    docs = []
    for i in range(120):
        parts = []
        for _ in range(rnd.randint(0, 5)):
            item = cut(rnd.choice(items[3:9])[1])
            a = rnd.randint(0, len(item))
            parts.append(rnd.choice([" ", ", ", "\n"]).join(item[a : a + rnd.randint(3, 20)]).upper())
            parts.append(" ".join(rnd.choice(words[8:]) for _ in range(rnd.randint(0, 8))))
        docs.append((i, ". ".join(parts)))
    return docs + [(500, None), (501, ""), (None, items[8][1]), (3, "w1 w2"), (3, "w1 w2")], items


@pytest.mark.parametrize("drop", [0, 3])
def test_equals_scan(spark, drop):
    docs, items = data()
    assert run(spark, docs, items[drop:]) == brute(docs, items[drop:])


@pytest.mark.parametrize(("docs", "items"), [([], [(1, "a b c")]), ([(1, "a b c")], []), ([], [])])
def test_empty(spark, docs, items):
    assert run(spark, docs, items) == brute(docs, items)
