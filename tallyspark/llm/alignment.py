"""Which tokens of one tokenizer stand for which of another.

Both cut the same bytes. All tokens of both are sorted by start, and the running maximum of their ends is
accumulated: where a start reaches it no earlier token goes on, so a group of overlapping tokens ends
there. All pairs of tokens of a group are linked. How many documents link two ids is counted over the whole
corpus, and each document learns which of its links are the usual ones.

Documents are put together in blocks of bounded size. A block sends each id pair that it has once, however
many documents and places hold it, so what is shuffled grows with the distinct pairs of blocks, and no id
pair has more rows than there are blocks.
"""

from __future__ import annotations

import functools
import hashlib
import json
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.session import staged

# Text that is encoded at once, links that are listed at once, and id pairs of a block, counted per document.
BATCH_BYTES, LINKS, BLOCK_PAIRS = 1 << 20, 2_000_000, 400_000
# How pieces write a space, and how byte-level vocabularies cut words.
SPACE = "▁"
WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
LONG_BLANK = re.compile(r"\s{1000}")  # the pattern above runs out of stack on longer ones


def byte_alphabet() -> dict[str, int]:
    """The character that byte-level vocabularies write for each byte: itself if it is visible, else one from 256 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + n): b for n, b in enumerate(hidden)}


def piece_bytes(piece: str) -> bytes:
    if len(piece) == 6 and piece.startswith("<0x") and piece.endswith(">"):
        return bytes([int(piece[3:5], 16)])
    return piece.replace(SPACE, " ").encode()


@dataclass
class Pair:
    """Both tokenizers, the bytes of their tokens, and the text that tokens are written as in an alignment."""

    byte_level: object
    quick: object | None
    pieces: object
    a_bytes: list[bytes]
    b_bytes: list[bytes]
    a_length: np.ndarray = field(init=False)
    b_length: np.ndarray = field(init=False)
    written: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        self.a_length = np.array([len(t) for t in self.a_bytes])
        self.b_length = np.array([len(t) for t in self.b_bytes])
        a, b = range(len(self.a_bytes)), range(len(self.b_bytes))
        # what follows a token: another of its side, the other side, or the next group
        self.written = np.array([f"{i}," for i in a] + [f"{i}|" for i in a] + [f"{i}," for i in b] + [f"{i};" for i in b], object)

    def encode(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        return [self.encode_bytes(" " + t) for t in texts], self.pieces.encode(texts, num_threads=1)

    def encode_bytes(self, text: str) -> list[int]:
        if self.quick is None or LONG_BLANK.search(text):
            return self.byte_level.encode(text, add_special_tokens=False).ids
        return self.quick.encode_ordinary(text)


def quick_encoder(path: str, tokenizer: object) -> object | None:
    """The same vocabulary in ``tiktoken``, which is several times as fast; None where its results could differ.

    It joins the neighbours whose joined text comes first, whichever two tokens they are. That is the same if ids count
    merges on from the 256 bytes and every token is encoded as itself: neighbours that no merge joins, but whose text is
    a token, can then never be left over.
    """
    import tiktoken

    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    model, alphabet, special = spec["model"], byte_alphabet(), {t["content"] for t in spec["added_tokens"]}
    split = {k: spec["pre_tokenizer"][k] for k in ("type", "add_prefix_space", "use_regex")}
    plain = {t: i for t, i in model["vocab"].items() if t not in special}
    merged = ["".join(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
    if (split != {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True} or spec["normalizer"] or model["end_of_word_suffix"]
            or any(len(t) != 1 for t, i in plain.items() if i < 256) or [plain.get(t) for t in merged] != list(range(256, len(plain)))
            or any([p.value for p in tokenizer.model.tokenize(t)] != [t] for t in plain)):
        return None
    ranks = {bytes(alphabet[c] for c in t): i for t, i in plain.items()}
    return tiktoken.Encoding("alignment", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})


@functools.lru_cache(maxsize=2)
def load(byte_level: str, pieces: str) -> Pair:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    import sentencepiece
    from tokenizers import Tokenizer

    first, second = Tokenizer.from_file(byte_level), sentencepiece.SentencePieceProcessor(model_file=pieces)
    first.encode_special_tokens = True
    alphabet = byte_alphabet()
    entries = {i: e for e, i in first.get_vocab(with_added_tokens=True).items()}
    a = [bytes(alphabet[c] for c in entries.get(i, "") if c in alphabet) for i in range(max(entries) + 1)]
    return Pair(first, quick_encoder(byte_level, first), second, a, [piece_bytes(second.id_to_piece(i)) for i in range(second.get_piece_size())])


@dataclass
class Aligned:
    """Texts that lie one behind the other. Token and group bounds have one entry more than there are texts."""

    a: np.ndarray
    b: np.ndarray
    a_group: np.ndarray
    b_group: np.ndarray
    a_bounds: np.ndarray
    b_bounds: np.ndarray
    group_bounds: np.ndarray
    a_in: np.ndarray = field(init=False)
    b_in: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        groups = int(self.group_bounds[-1])
        self.a_in, self.b_in = np.bincount(self.a_group, minlength=groups), np.bincount(self.b_group, minlength=groups)

    def links(self) -> np.ndarray:
        """Linked occurrences per text."""
        total = np.concatenate([[0], np.cumsum(self.a_in * self.b_in)])
        return total[self.group_bounds[1:]] - total[self.group_bounds[:-1]]

    def written(self, pair: Pair) -> list[str]:
        """``a1,a2|b1;a3|b2,b3`` per text."""
        a_before, b_before = (np.concatenate([[0], np.cumsum(n)]) for n in (self.a_in, self.b_in))
        entry = np.empty(len(self.a) + len(self.b), np.int64)
        at = np.arange(len(self.a))
        last = at == a_before[self.a_group + 1] - 1
        entry[at + b_before[self.a_group]] = self.a + last * len(pair.a_bytes)
        at = np.arange(len(self.b))
        last = at == b_before[self.b_group + 1] - 1
        entry[at + a_before[self.b_group + 1]] = self.b + last * len(pair.b_bytes) + 2 * len(pair.a_bytes)
        texts = pair.written[entry].tolist()
        bounds = (self.a_bounds + self.b_bounds).tolist()
        return ["".join(texts[s:e])[:-1] for s, e in zip(bounds[:-1], bounds[1:], strict=True)]

    def id_pairs(self, ids: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct id pairs of each text, as a * ``ids`` + b, with their number of links, and how many pairs texts have.

        Links are listed in portions; of a large group only its distinct ids are paired.
        """
        a, b, a_group, b_group = self.a.astype(np.int64), self.b.astype(np.int64), self.a_group, self.b_group
        a_times, b_times, a_in, b_in = np.ones(len(a), np.int64), np.ones(len(b), np.int64), self.a_in, self.b_in
        if (a_in * b_in).max(initial=0) > 10_000:
            a_group, a, a_times = _distinct(a_group, a, len(a_in))
            b_group, b, b_times = _distinct(b_group, b, len(a_in))
            a_in, b_in = np.bincount(a_group, minlength=len(a_in)), np.bincount(b_group, minlength=len(a_in))
        b_first = np.concatenate([[0], np.cumsum(b_in)])[:-1]
        text = np.searchsorted(self.group_bounds, np.arange(len(a_in)), "right") - 1
        total = np.concatenate([[0], np.cumsum(b_in[a_group])])  # links up to each a token
        parts: list[tuple[np.ndarray, np.ndarray]] = []
        held = at = 0
        while at < len(a):
            end = max(int(np.searchsorted(total, total[at] + LINKS, "right")) - 1, at + 1)
            which = np.repeat(np.arange(at, end), b_in[a_group[at:end]])
            group = a_group[which]
            other = b_first[group] + np.arange(total[at], total[end]) - total[which]
            parts.append(_summed((text[group] << 32) | (a[which] * ids + b[other]), a_times[which] * b_times[other]))
            held += len(parts[-1][0])
            if held > 2 * LINKS and len(parts) > 1:
                parts = [_summed(*(np.concatenate(p) for p in zip(*parts, strict=True)))]
                held = -len(parts[0][0])  # grows by as much again before the next time
            at = end
        if not parts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(self.a_bounds) - 1, np.int64)
        key, times = parts[0] if len(parts) == 1 else _summed(*(np.concatenate(p) for p in zip(*parts, strict=True)))
        return key & 0xFFFFFFFF, times, np.bincount(key >> 32, minlength=len(self.a_bounds) - 1)


def _distinct(group: np.ndarray, ids: np.ndarray, groups: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    key, times = np.unique((group.astype(np.int64) << 32) | ids, return_counts=True)
    return key >> 32, key & 0xFFFFFFFF, times


def _summed(key: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(key)
    key = key[order]
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1])[: len(key)])
    return key[first], np.add.reduceat(times[order], first) if len(first) else times


def coalesce(a_start: np.ndarray, a_end: np.ndarray, b_start: np.ndarray, b_end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Group number of each token of both sides, from their byte ranges."""
    start, end = np.concatenate([a_start, b_start]), np.concatenate([a_end, b_end])
    order = np.lexsort((np.arange(len(start)) >= len(a_start), start))
    reach = np.maximum.accumulate(end[order])
    new = np.zeros(len(start), np.int64)
    new[1:] = start[order][1:] >= reach[:-1]
    group = np.empty(len(start), np.int64)
    group[order] = np.cumsum(new)
    return group[: len(a_start)], group[len(a_start) :]


def align_texts(texts: list[str], pair: Pair) -> tuple[np.ndarray, Aligned]:
    """The texts that both tokenizers give back whole, by number, and their alignment."""
    kept, a_ids, b_ids = [], [], []
    for n, (a, b) in enumerate(zip(*pair.encode(texts), strict=True)):
        if not texts[n]:
            continue
        raw = (" " + texts[n]).encode()
        if b"".join(map(pair.a_bytes.__getitem__, a)) == raw and b"".join(map(pair.b_bytes.__getitem__, b)) == raw:
            kept.append(n)
            a_ids.append(np.array(a, np.int32))
            b_ids.append(np.array(b, np.int32))
    a, b = (np.concatenate(ids) if ids else np.zeros(0, np.int32) for ids in (a_ids, b_ids))
    a_bounds, b_bounds = (np.concatenate([[0], np.cumsum([len(i) for i in ids])]).astype(np.int64) for ids in (a_ids, b_ids))
    a_end, b_end = np.cumsum(pair.a_length[a]), np.cumsum(pair.b_length[b])
    a_group, b_group = coalesce(a_end - pair.a_length[a], a_end, b_end - pair.b_length[b], b_end)
    groups = int(a_group[-1]) + 1 if len(a) else 0
    return np.array(kept, np.int64), Aligned(a, b, a_group, b_group, a_bounds, b_bounds, np.append(a_group[a_bounds[:-1]], groups))


def _portions(column: pa.Array) -> Iterator[tuple[int, list[str]]]:
    """Texts of about ``BATCH_BYTES`` together, with the number of the first."""
    at, held, size = 0, [], 0
    for n, text in enumerate(column.to_pylist()):
        if held and size + len(text) > BATCH_BYTES:
            yield at, held
            at, held, size = n, [], 0
        held.append(text)
        size += len(text)
    if held:
        yield at, held


def _spread(count: int, kept: np.ndarray, values: np.ndarray) -> np.ndarray:
    out = np.zeros(count, np.int64)
    out[kept] = values
    return out


def _rows(docs: DataFrame) -> tuple[DataFrame, str]:
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")), docs.schema["doc_id"].dataType.simpleString()


def align(docs: DataFrame, byte_level: str, pieces: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links and ``groups`` of every row of ``docs`` (doc_id, text).

    ``byte_level`` is a byte-level file of the ``tokenizers`` library, for a space and the text; ``pieces`` a model of
    ``sentencepiece``, which adds that space itself. Both are readable on every executor. ``groups`` is written
    ``a1,a2|b1;a3|b2,b3``, the ids of each side of each group. Texts that are NULL or empty, or whose tokens don't join
    to the same bytes, have no tokens: zeros and an empty ``groups``. Rows are aligned one by one: repeated rows, equal
    texts and NULL ids stay as they are, an empty table gives none, other columns are ignored. A very long text is
    aligned whole; memory grows with its tokens and its distinct id pairs.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = load(byte_level, pieces)
        for batch in batches:
            for at, texts in _portions(batch.column("text")):
                kept, found = align_texts(texts, pair)
                written = [""] * len(texts)
                for n, text in zip(kept, found.written(pair), strict=True):
                    written[n] = text
                sizes = [_spread(len(texts), kept, v) for v in (*map(np.diff, (found.a_bounds, found.b_bounds, found.group_bounds)), found.links())]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(at, len(texts)), *map(pa.array, sizes), pa.array(written, pa.string())],
                                                 ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups"])

    rows, kind = _rows(docs)
    return rows.mapInArrow(run, f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, groups string")


SIZES = ["n_a", "n_b", "n_groups", "n_links"]


def _packed(values: np.ndarray) -> bytes:
    """Small whole numbers, byte by byte of equal weight, compressed."""
    planes = np.ascontiguousarray(values.astype("<i8").view(np.uint8).reshape(-1, 8).T)
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def _unpacked(data: bytes, count: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(data, 8 * count, codec="zstd", asbytes=True), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<i8").ravel()


class _Block:
    """Documents whose id pairs are counted together, one row of the table of blocks."""

    def __init__(self) -> None:
        self.ids, self.sizes, self.digests, self.codes, self.times, self.pairs = [], [], [], [], [], []
        self.size = 0

    def add(self, ids: pa.Array, sizes: np.ndarray, digests: list[str], codes: np.ndarray, times: np.ndarray, pairs: np.ndarray) -> None:
        for held, new in zip((self.ids, self.sizes, self.digests, self.codes, self.times, self.pairs), (ids, sizes, digests, codes, times, pairs), strict=True):
            held.append(new)
        self.size += len(codes) + len(ids)

    def row(self, number: int) -> pa.RecordBatch:
        codes, pairs, sizes = np.concatenate(self.codes), np.concatenate(self.pairs), np.concatenate(self.sizes, axis=1)
        distinct, places, docs = np.unique(codes, return_inverse=True, return_counts=True)
        # within a document places grow: the steps are small
        steps = np.diff(places, prepend=0)
        first = np.concatenate([[0], np.cumsum(pairs)[:-1]])[pairs > 0]
        steps[first] = places[first]
        nested = [pa.concat_arrays(self.ids), *map(pa.array, sizes), pa.array([d for part in self.digests for d in part], pa.string()), pa.array(pairs, pa.int64())]
        lists = [pa.array(distinct, pa.int64()), pa.array(docs, pa.int64()), *nested]
        one = [pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), v) for v in lists]
        blobs = [pa.array([_packed(v)], pa.binary()) for v in (steps, np.concatenate(self.times))]
        return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), *one, *blobs],
                                          ["block", "codes", "docs", "doc_id", *SIZES, "groups_sha256", "n_pairs", "steps", "times"])


def _blocks(docs: DataFrame, byte_level: str, pieces: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, number, block = load(byte_level, pieces), TaskContext.get().partitionId() << 32, _Block()
        for batch in batches:
            for at, texts in _portions(batch.column("text")):
                kept, found = align_texts(texts, pair)
                digests = [""] * len(texts)
                for n, text in zip(kept, found.written(pair), strict=True):
                    digests[n] = hashlib.sha256(text.encode()).hexdigest()
                sizes = np.stack([_spread(len(texts), kept, v) for v in (*map(np.diff, (found.a_bounds, found.b_bounds, found.group_bounds)), found.links())])
                codes, times, pairs = found.id_pairs(len(pair.b_bytes))
                block.add(batch.column("doc_id").slice(at, len(texts)), sizes, digests, codes, times, _spread(len(texts), kept, pairs))
                if block.size >= BLOCK_PAIRS:
                    yield block.row(number)
                    number, block = number + 1, _Block()
        if block.size:
            yield block.row(number)

    rows, kind = _rows(docs)
    numbers = ", ".join(f"{n} array<long>" for n in SIZES)
    return rows.mapInArrow(run, f"block long, codes array<long>, docs array<long>, doc_id array<{kind}>, {numbers}, groups_sha256 array<string>, "
                                "n_pairs array<long>, steps binary, times binary")


def pair_counts(blocks: DataFrame, ids: int) -> DataFrame:
    """code, docs, best: how many documents link each id pair, and whether no pair of its first id is linked by more.

    ``ids`` is the number of ids of the second tokenizer; a code is a * ids + b. There is at most one best count for
    each id of the first tokenizer, so these may be broadcast.
    """
    pairs = blocks.select(F.inline(F.arrays_zip("codes", "docs"))).toDF("code", "docs")
    counted = staged(pairs.groupBy("code").agg(F.sum("docs").alias("docs")), "pair-counts").withColumn("a", F.expr(f"code div {ids}"))
    most = counted.groupBy("a").agg(F.max("docs").alias("most"))
    return counted.join(F.broadcast(most), "a").select("code", "docs", (F.col("docs") == F.col("most")).alias("best"))


def link_report(docs: DataFrame, byte_level: str, pieces: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of every row of ``docs``.

    As ``align``. An id pair's count is the number of rows of ``docs`` that hold it linked. ``count_sum`` adds the counts
    of all links, ``n_best`` says how many links have the highest count of their first id, ties included. Rows without
    tokens have zeros and an empty digest.
    """
    blocks = staged(_blocks(docs, byte_level, pieces), "alignment-blocks")
    counts = pair_counts(blocks, load(byte_level, pieces).pieces.get_piece_size())
    wanted = blocks.select("block", F.explode("codes").alias("code"))
    known = wanted.join(counts, "code").select(F.col("block").alias("wanted_by"), "code", F.expr("2 * docs + int(best)").alias("value"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", *SIZES, "n_best", "count_sum", "groups_sha256"]

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        code, value = (right.column(c).to_numpy() for c in ("code", "value"))
        value = value[np.argsort(code)]  # codes of a block are distinct and its places count them in order
        row = {c: left.column(c).combine_chunks()[0] for c in left.column_names}
        pairs = row["n_pairs"].values.to_numpy()
        steps, times = (_unpacked(row[c].as_py(), int(pairs.sum())) for c in ("steps", "times"))
        document = np.repeat(np.arange(len(pairs)), pairs)
        total = np.cumsum(steps)
        first = np.concatenate([[0], np.cumsum(pairs)[:-1]])
        has = pairs > 0
        before = np.zeros(len(pairs), np.int64)
        before[has] = total[first[has]] - steps[first[has]]
        found = value[total - before[document]] if len(document) else value
        ends = np.concatenate([[0], np.cumsum(pairs)])
        sums = [np.concatenate([[0], np.cumsum(v)])[ends] for v in (times * (found & 1), times * (found >> 1))]
        columns = [row["doc_id"].values, *(row[c].values for c in SIZES), *(pa.array(np.diff(s)) for s in sums), row["groups_sha256"].values]
        return pa.table(columns, names=names)

    schema = f"doc_id {kind}, " + ", ".join(f"{n} long" for n in names[1:-1]) + ", groups_sha256 string"
    return blocks.drop("codes", "docs").groupBy("block").cogroup(known.groupBy("wanted_by")).applyInArrow(score, schema)
