"""Packing: every id once, pieces side by side, little padding; the linear program against an exact bound."""

import collections
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tallyspark.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


def check(rows, docs, length, end=2):
    library = Tokenizer.from_file(PATH)
    want = collections.Counter()
    for i, text in docs:
        ids = library.encode(text or "", add_special_tokens=False).ids + [end]
        for s in range(0, len(ids), length):
            part = ids[s : s + length]
            want[i, s, len(part), zlib.crc32(np.array(part, "<u4").tobytes()), len(ids)] += 1
    assert collections.Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in rows) == want
    sequences = collections.defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for pieces in sequences.values():
        at = 0
        for offset, size in sorted(pieces):
            assert offset == at
            at += size
        assert at <= length
    return len(sequences)


def test_pieces(spark):
    rnd = random.Random(1)
    docs = [(i, " ".join(rnd.choice(["the", "Straße", "naïve", "x1y2", "don't", "日本", "…"]) for _ in range(rnd.randint(0, 400)))) for i in range(300)]
    docs += [(900, None), (901, ""), (None, "a b"), (1, docs[1][1]), (1, docs[1][1])]
    rows = packing.pack(spark.createDataFrame([(*d, 7) for d in docs], "doc_id long, text string, offset int").repartition(3), PATH, 2, 512, 8).collect()
    used = check(rows, docs, 512)
    assert used * 512 <= 1.05 * sum(r.length for r in rows) + 512


def test_with_ids(spark):
    docs = spark.createDataFrame([(1, "a small text"), (2, "")], "doc_id long, text string")
    for r in packing.cut(docs, PATH, 2, 3, with_ids=True).collect():
        assert len(r.ids) == r.length and zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32


def test_empty(spark):
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string"), PATH, 2).collect() == []


@pytest.mark.parametrize("seed", range(5))
def test_plan_fills_sequences(seed):
    rnd = random.Random(seed)
    histogram = {c: rnd.choice([1, 3, 1000, 10**9]) for c in rnd.sample(range(1, 65), 20)}
    made = packing.plan(histogram, 64)
    sizes = np.array(sorted(histogram))
    best = sum(x for _, x in packing.cutting_stock(sizes, np.array([float(histogram[c]) for c in sizes]), 64))
    assert best / packing.NEAR - 1 <= made.total <= best + len(sizes)  # rounding costs a sequence for each class at most
    for c, n in histogram.items():
        ranks = np.array([0, n // 2, n - 1])
        sequence, _ = made.slot(np.full(3, c), ranks)
        assert (0 <= sequence).all() and (sequence < made.total).all()


def test_linear_program_is_optimal():
    """Halves and thirds: the best is known."""
    found = packing.cutting_stock(np.array([3, 4, 6]), np.array([40.0, 30.0, 10.0]), 12)
    assert sum(x for _, x in found) == pytest.approx(25.0)
