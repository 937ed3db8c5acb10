"""Packing documents into training sequences as a cutting-stock problem.

Documents are cut at full sequences; what remains of each is one piece shorter than a sequence. The
histogram of piece lengths, whatever the number of documents, has at most as many bars as a sequence has tokens.
Over it a linear program on patterns (how many pieces of which length class fill one sequence) is
solved by column generation: dual prices of the classes go into a knapsack dynamic program,
whose best pattern enters the basis, until none is worth more than a sequence. Rounded down, the
patterns say how many sequences of each kind there are; the remainder is filled first-fit. Every class has as
many slots as pieces, so ranking the pieces of a class assigns them: rank k takes slot k.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.llm import bpe
from tallyspark.session import staged

LENGTH = 4096
GRAIN = 16  # tokens per length class: at most this less one is lost for each piece
NEAR = 1.0005  # a pattern must be worth more than this many sequences to enter
PER_RANKING = 5_000  # pieces that are ranked together


def cut(docs: DataFrame, vocabulary: str, end_id: int, length: int = LENGTH, with_ids: bool = False) -> DataFrame:
    """Pieces of all documents: doc_id, start, length, ids_crc32, doc_tokens, and ids if asked for.

    A document is its token ids and then ``end_id``; NULL and empty texts are the end alone. Every
    piece but a document's last fills a sequence. Rows with equal or NULL ids are documents of their own.
    """

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = bpe.tokenizer(vocabulary)
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.slice(at, 256)
                counts, ids = tokenizer.encode(part.column("text").to_pylist())
                ends = np.cumsum(counts)
                ids = np.insert(ids, ends, end_id).astype("<u4")
                totals = counts + 1
                firsts = np.cumsum(totals) - totals
                cuts = -(-totals // length)
                row = np.repeat(np.arange(len(totals)), cuts)
                start = (np.arange(len(row)) - np.repeat(np.cumsum(cuts) - cuts, cuts)) * length
                size = np.minimum(length, totals[row] - start)
                begin = firsts[row] + start
                raw = ids.tobytes()
                crc = [zlib.crc32(raw[4 * b : 4 * (b + n)]) for b, n in zip(begin, size, strict=True)]
                columns = [part.column("doc_id").take(pa.array(row)), pa.array(start), pa.array(size), pa.array(crc, pa.int64()), pa.array(totals[row])]
                names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
                if with_ids:  # pieces follow each other without gaps
                    columns.append(pa.ListArray.from_arrays(pa.array(np.append(begin, len(ids)), pa.int32()), pa.array(ids.astype(np.int32))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long" + ", ids array<int>" * with_ids
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(pieces, schema)


def best_pattern(prices: np.ndarray, sizes: np.ndarray, capacity: int) -> tuple[float, dict[int, int]]:
    """The dearest way to fill ``capacity`` with items, by dynamic programming over capacities."""
    value, choice = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    for room in range(1, capacity + 1):
        fits = np.searchsorted(sizes, room, "right")  # sizes rise
        value[room] = value[room - 1]
        if fits:
            worth = prices[:fits] + value[room - sizes[:fits]]
            k = int(worth.argmax())
            if worth[k] > value[room] + 1e-12:
                value[room], choice[room] = worth[k], k
    pattern: dict[int, int] = {}
    room = capacity
    while room > 0:
        k = int(choice[room])
        if k < 0:
            room -= 1
            continue
        pattern[k] = pattern.get(k, 0) + 1
        room -= int(sizes[k])
    return float(value[capacity]), pattern


def cutting_stock(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> list[tuple[dict[int, int], float]]:
    """Patterns and their amounts that cover ``demand`` with the fewest sequences, fractions allowed."""
    m = len(sizes)
    patterns: list[dict[int, int]] = [{k: int(capacity // sizes[k])} for k in range(m)]
    inverse = np.diag([1.0 / p[k] for k, p in enumerate(patterns)])
    amount = inverse @ demand
    while True:
        prices = inverse.sum(axis=0)
        worth, pattern = best_pattern(prices, sizes, capacity)
        if worth <= NEAR:
            return [(p, float(x)) for p, x in zip(patterns, amount, strict=True)]
        column = inverse[:, list(pattern)] @ np.array(list(pattern.values()), float)
        ratio = np.where(column > 1e-9, np.maximum(amount, 0) / np.where(column > 1e-9, column, 1), np.inf)
        out = int(ratio.argmin())
        step = ratio[out]
        pivot = inverse[out] / column[out]
        inverse -= np.outer(column, pivot)
        inverse[out] = pivot
        amount -= column * step
        amount[out] = step
        patterns[out] = pattern


@dataclass
class Plan:
    """Slots of every class in order: runs of (class, first rank, sequences from, per sequence, first slot number)."""

    classes: np.ndarray
    ranks: np.ndarray
    sequences: np.ndarray
    each: np.ndarray
    slots: np.ndarray
    total: int  # sequences

    def slot(self, group: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        run = np.searchsorted(self.classes * (1 << 44) + self.ranks, group * (1 << 44) + rank, "right") - 1
        within = rank - self.ranks[run]
        return self.sequences[run] + within // self.each[run], self.slots[run] + within % self.each[run]


def plan(histogram: dict[int, int], capacity: int) -> Plan:
    """Whole sequences for the pieces of each class (in grains); classes of ``capacity`` fill one each."""
    sizes = np.array(sorted(c for c in histogram if c < capacity), np.int64)
    left = np.array([histogram[int(c)] for c in sizes], np.int64)
    whole: list[tuple[dict[int, int], int]] = []
    if len(sizes):
        for pattern, amount in cutting_stock(sizes, left.astype(float), capacity):
            times = int(np.floor(amount + 1e-9))
            times = min([times, *(int(left[k] // n) for k, n in pattern.items())])
            if times > 0:
                whole.append((pattern, times))
                for k, n in pattern.items():
                    left[k] -= n * times
        while left.any():  # first fit, largest first, as often as the fill can be repeated
            room, pattern = capacity, {}
            for k in range(len(sizes) - 1, -1, -1):
                n = min(int(left[k]), room // int(sizes[k]))
                if n:
                    pattern[k] = n
                    room -= n * int(sizes[k])
            times = min(int(left[k] // n) for k, n in pattern.items())
            whole.append((pattern, times))
            for k, n in pattern.items():
                left[k] -= n * times
    runs, used, base = [], {}, 0
    for pattern, times in whole:
        slot = 0
        for k, n in sorted(pattern.items(), reverse=True):
            c = int(sizes[k])
            runs.append((c, used.get(c, 0), base, n, slot))
            used[c] = used.get(c, 0) + n * times
            slot += n
        base += times
    if histogram.get(capacity):
        runs.append((capacity, 0, base, 1, 0))
        base += histogram[capacity]
    columns = np.array(sorted(runs), np.int64).reshape(-1, 5).T
    return Plan(*columns, base)


def assign(pieces: DataFrame, length: int = LENGTH, grain: int = GRAIN) -> DataFrame:
    """Add sequence_id and offset to a written table of pieces.

    Ranks come from counts: pieces are ranked within small shares of a class, shares are put one after the other. So
    no task ranks a whole class, although one length may belong to a third of all documents.
    """
    group = F.ceil(F.col("length") / grain).cast("long")
    histogram = {r["c"]: r["count"] for r in pieces.groupBy(group.alias("c")).count().collect()}  # at most length / grain rows
    shares = max(1, -(-sum(histogram.values()) // PER_RANKING))
    ready = plan(histogram, length // grain)
    order = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    spread = pieces.withColumns({"c": group, "share": F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(shares))})
    before = Window.partitionBy("c").orderBy("share").rowsBetween(Window.unboundedPreceding, -1)
    firsts = spread.groupBy("c", "share").count().select("c", "share", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("first"))
    rank = F.row_number().over(Window.partitionBy("c", "share").orderBy(*order)) - 1
    ranked = spread.withColumn("rank", rank).join(firsts, ["c", "share"]).withColumn("rank", F.col("rank") + F.col("first"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sequence, slot = ready.slot(batch.column("c").to_numpy(), batch.column("rank").to_numpy())
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in order), pa.array(sequence), pa.array(slot)], [*order, "sequence_id", "slot"])

    kind = pieces.schema["doc_id"].dataType.simpleString()
    placed = ranked.select(*order, "c", "rank").mapInArrow(
        place, f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, slot long")
    within = Window.partitionBy("sequence_id").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    return placed.select(*order, "sequence_id", F.coalesce(F.sum("length").over(within), F.lit(0)).alias("offset"))


def pack(docs: DataFrame, vocabulary: str, end_id: int, length: int = LENGTH, grain: int = GRAIN) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    ``docs`` has doc_id and text; other columns are ignored. Every id of every document lies in exactly one piece, and the
    pieces of a sequence lie side by side from 0. An empty table gives no pieces. NULL texts are
    packed as empty ones (the end alone), repeated rows as often as they occur.
    """
    return assign(staged(cut(docs, vocabulary, end_id, length), "pieces"), length, grain)
