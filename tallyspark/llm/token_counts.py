"""Token counts by prefix dynamic programming.

One pass over a word leaves the exact count of tokens at each of its prefixes; sums over the words
before it make that the count at every prefix of the text. With these counts stored, questions about
truncation and budgets need no further encoding.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.llm import bpe

LIMIT = 1024


def count_tokens(docs: DataFrame, vocabulary: str, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every row of ``docs`` (doc_id, text).

    ``vocabulary`` is a tokenizer file of the ``tokenizers`` library, readable on every executor. NULL and
    empty texts have no tokens. Rows are counted one by one: repeated rows and NULL ids stay as they are.
    Other columns are ignored.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = bpe.tokenizer(vocabulary)
        for batch in batches:
            counts, _ = tokenizer.encode(batch.column("text").to_pylist(), want_ids=False)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_bytes"), pa.array(counts)], ["doc_id", "n_bytes", "n_tokens"])

    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", text.alias("text"), F.octet_length(text).cast("long").alias("n_bytes"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(count, f"doc_id {kind}, n_bytes long, n_tokens long").withColumn("over_limit", F.col("n_tokens") > limit)


def prefix_counts(text: str, tokenizer: bpe.Tokenizer) -> np.ndarray:
    """Exact token count of ``text[:k]`` for k from 0 to its length.

    For byte-level vocabularies without a normaliser. A special string counts as one token once it is whole.
    """
    if tokenizer.lower:
        raise ValueError("prefixes of normalised texts are not prefixes of the text")
    out, at, before = np.zeros(len(text) + 1, np.int64), 0, 0
    parts = tokenizer.special.split(text) if tokenizer.special else [text]
    for n, part in enumerate(parts):
        if n % 2:
            # the string is plain text until its last character; it may be a word with what comes before
            head = parts[n - 1]
            for k in range(1, len(part)):
                out[at + k] = before - base + tokenizer.encode([head + part[:k]], want_ids=False)[0][0]
            before += 1
            at += len(part)
            out[at] = before
            continue
        base = 0
        if part:
            codes = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), np.uint32)
            kind = bpe._classes()[codes]
            spaces = np.concatenate([[False], kind == bpe.SPACE, [False]])
            runs = np.flatnonzero(spaces[1:] != spaces[:-1]).reshape(-1, 2)
            starts, ends = tokenizer.words(codes)
            words = [part[s:e] for s, e in zip(starts, ends, strict=True)]
            blanks = [part[s:e] for s, e in runs]
            known = {w: _word_prefixes(w, tokenizer) for w in {*words, *blanks}}
            sums = np.concatenate([[0], np.cumsum([known[w][-1] for w in words])])
            for w, s, e, total in zip(words, starts, ends, sums[:-1], strict=True):
                out[at + s + 1 : at + e + 1] = before + total + known[w][1:]
                if w in ("'re", "'ve", "'ll"):  # cut in half, an apostrophe and a word
                    out[at + s + 2] = before + total + 2
            # white space that a prefix ends with is one word, whatever follows in the whole text
            for w, (s, e) in zip(blanks, runs, strict=True):
                total = sums[np.searchsorted(starts, s)]
                out[at + s + 1 : at + e + 1] = before + total + known[w][1:]
            base = int(sums[-1])
            before += base
        at += len(part)
    return out


def _word_prefixes(word: str, tokenizer: bpe.Tokenizer) -> np.ndarray:
    """Counts at the code points of one word."""
    raw = np.frombuffer(word.encode("utf-8", "surrogatepass"), np.uint8)
    count, _ = tokenizer.long_prefixes(raw.astype(np.int16))
    return count[np.append(np.flatnonzero((raw & 0xC0) != 0x80), len(raw))]


def prefix_table(docs: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id, n_tokens and ``steps``: the change of the count at each character, a signed byte each.

    A step fits a byte because a token has at most 128 bytes. NULL counts as empty.
    """

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = bpe.tokenizer(vocabulary)
        for batch in batches:
            counts = [prefix_counts(t, tokenizer) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([int(c[-1]) for c in counts], pa.int64()),
                 pa.array([np.diff(c).astype(np.int8).tobytes() for c in counts], pa.binary())], ["doc_id", "n_tokens", "steps"])

    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(store, f"doc_id {kind}, n_tokens long, steps binary")


def longest_prefix(steps: Column, budget: int) -> Column:
    """Characters of the longest prefix with at most ``budget`` tokens, from stored steps alone."""

    @F.pandas_udf("long")
    def longest(column):
        return column.map(lambda s: int(np.flatnonzero(np.concatenate([[0], np.cumsum(np.frombuffer(s, np.int8), dtype=np.int64)]) <= budget)[-1]))

    return longest(steps)


def tokens_at(steps: Column, position: Column) -> Column:
    """Tokens of the prefix with ``position`` characters, from stored steps alone."""

    @F.pandas_udf("long")
    def count(column, at):
        return column.combine(at, lambda s, k: int(np.frombuffer(s, np.int8)[:k].sum(dtype=np.int64)))

    return count(steps, position)
