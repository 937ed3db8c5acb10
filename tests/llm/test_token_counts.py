"""Counts and ids against the library, and stored prefix counts against encoding every prefix."""

import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallyspark.llm import bpe, token_counts

PARTS = ["'s", "'t", "'re", "'", " ", "  ", "\n", "\t", "a", "don", "1", "23", "é", "é", "ñ", "ß", "İ", "Σ", "...", "日本", "한국", "😀", "\x1c", "\x85", "½",
         "<|endoftext|>", "<|startoftext|>", "<|", "'RE", "$$$", "the", "ing", "﻿", "\x00"]


def texts(n=400):
    rnd = random.Random(5)
    return ["".join(rnd.choice(PARTS) for _ in range(rnd.randint(0, 25))) for _ in range(n)] + ["", "a" * 300, "日本" * 80, " " * 100 + "x", "\n" * 130]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_ids_equal_library(name, monkeypatch):
    monkeypatch.setattr(bpe, "SLICE", 40)  # texts are cut into several parts
    library, own = Tokenizer.from_file(public_tokenizers.path(name)), bpe.Tokenizer(public_tokenizers.path(name))
    want = [e.ids for e in library.encode_batch(texts(), add_special_tokens=False)]
    counts, ids = own.encode(texts())
    assert counts.tolist() == [len(w) for w in want]
    assert ids.tolist() == [i for w in want for i in w]


def test_prefixes():
    path = public_tokenizers.path("byte_bpe_50k.json")
    library, own = Tokenizer.from_file(path), bpe.tokenizer(path)
    for text in texts(60)[:60] + ["a <|endoftext|> b<|endoftext|>", ""]:
        want = [len(library.encode(text[:k], add_special_tokens=False).ids) for k in range(len(text) + 1)]
        assert token_counts.prefix_counts(text, own).tolist() == want, text


def test_query(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    rows = [(1, "one two", 5), (2, None, 5), (2, "", 5), (None, "x " * 2000, 5), (None, "x " * 2000, 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_bytes int")
    got = sorted(tuple(r) for r in token_counts.count_tokens(docs, path).select(F.coalesce("doc_id", F.lit(-1)), "n_bytes", "n_tokens", "over_limit").collect())
    want = sorted((i if i is not None else -1, len((t or "").encode()), n := len(library.encode(t or "").ids), n > 1024) for i, t, _ in rows)
    assert got == want
    assert token_counts.count_tokens(docs.limit(0), path).count() == 0


def test_stored_prefixes_answer_budgets(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    text = "Hello wörld, this isn't a test…  \n ok"
    stored = token_counts.prefix_table(spark.createDataFrame([(1, text), (2, None)], "doc_id long, text string"), path)
    size = [len(library.encode(text[:k]).ids) for k in range(len(text) + 1)]
    r = stored.where("doc_id = 1").select(token_counts.longest_prefix(F.col("steps"), 7).alias("k"), token_counts.tokens_at(F.col("steps"), F.lit(20)).alias("t")).first()
    assert r.k == max(k for k, n in enumerate(size) if n <= 7) and r.t == size[20]
    assert np.array_equal([x.n_tokens for x in stored.orderBy("doc_id").collect()], [size[-1], 0])
