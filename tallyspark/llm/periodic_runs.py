"""Stretches of words that repeat with a period, and texts without the repetitions.

Longest common extensions come from a difference cover: of all suffixes only those that start at a
position whose remainder is in the cover are sorted. Any two positions reach two sampled ones by the
same few steps, so an extension is these few words compared, then a minimum over the common prefixes of
neighbours in the sorted order, which a sparse table answers at once. A run of period q holds a point of
the grid of q, so asking the extensions of every grid point and the point q words on finds all runs; the
grids together have about n ln n points.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MIN_WORDS = 12  # shortest run
# Every remainder modulo 13 is a difference of two members of the cover.
MODULUS, COVER = 13, (0, 1, 3, 9)
# Words that are looked at together; a longer text is looked at alone.
CHUNK_WORDS = 400_000
GRID_POINTS = 1_000_000

RUNS = "array<struct<start:long,length:long,period:long>>"


class Extensions:
    """How far a sequence goes on alike from two of its positions.

    The last element must be found nowhere else, so that no extension reaches the end.
    """

    def __init__(self, words: np.ndarray):
        per, blocks = len(COVER), len(words) // MODULUS + 3
        padded = np.empty(blocks * MODULUS + MODULUS, np.int64)
        padded[: len(words)] = words
        top = int(words.max()) + 1
        padded[len(words) :] = np.arange(top, top + len(padded) - len(words))
        self.words = padded
        # shift[d]: cover member c with c + d in the cover too
        self.shift = np.array([next(c for c in COVER if (c + d) % MODULUS in COVER) for d in range(MODULUS)])
        self.place = np.zeros(MODULUS, np.int64)
        self.place[list(COVER)] = np.arange(per)
        starts = (np.arange(blocks)[:, None] * MODULUS + np.array(COVER)).ravel()

        levels = [self._first_ranks(starts, int(padded.max()) + 1)]
        while levels[-1].max() + 1 < len(starts):
            ranks, step = levels[-1], per << (len(levels) - 1)
            beyond = np.zeros(len(starts), np.int64)
            beyond[: -step or None] = ranks[step:] + 1
            levels.append(np.unique(ranks * (len(starts) + 1) + beyond, return_inverse=True)[1])
        self.rank = levels[-1]
        order = np.empty(len(starts), np.int64)
        order[self.rank] = np.arange(len(starts))
        self.table = self._minima(self._neighbours(levels, starts, order))

    def _first_ranks(self, starts: np.ndarray, top: int) -> np.ndarray:
        """Rank of the first ``MODULUS`` words of each sampled suffix."""
        bits = max(int(top).bit_length(), 1)
        together = max(1, 62 // bits)
        keys = []
        for at in range(0, MODULUS, together):
            key = np.zeros(len(starts), np.int64)
            for word in range(at, min(at + together, MODULUS)):
                key = (key << bits) | self.words[starts + word]
            keys.append(key)
        order = np.lexsort(keys[::-1])
        new = np.zeros(len(starts), bool)
        for key in keys:
            sorted_key = key[order]
            new[1:] |= sorted_key[1:] != sorted_key[:-1]
        ranks = np.empty(len(starts), np.int64)
        ranks[order] = np.cumsum(new)
        return ranks

    def _neighbours(self, levels: list[np.ndarray], starts: np.ndarray, order: np.ndarray) -> np.ndarray:
        """Common prefix of each suffix in the order with the next, by halving steps and then word by word."""
        a, b = order[:-1].copy(), order[1:].copy()
        length = np.zeros(len(a), np.int64)
        for k in range(len(levels) - 1, -1, -1):
            inside = np.flatnonzero(np.maximum(a, b) < len(starts))
            same = inside[levels[k][a[inside]] == levels[k][b[inside]]]
            a[same] += len(COVER) << k
            b[same] += len(COVER) << k
            length[same] += MODULUS << k
        active = np.flatnonzero(np.maximum(a, b) < len(starts))
        for step in range(MODULUS):
            active = active[self.words[starts[a[active]] + step] == self.words[starts[b[active]] + step]]
            length[active] += 1
        return length

    @staticmethod
    def _minima(values: np.ndarray) -> np.ndarray:
        """Row k holds the minimum of the 2^k values from each place on."""
        table = np.zeros((max(len(values), 1).bit_length(), max(len(values), 1)), np.int32)
        table[0, : len(values)] = values
        for k in range(1, len(table)):
            half = 1 << (k - 1)
            table[k, :-half] = np.minimum(table[k - 1, :-half], table[k - 1, half:])
        return table

    def lengths(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Words that the sequence has in common from positions ``i`` and from positions ``j`` on, which differ."""
        steps = (self.shift[(j - i) % MODULUS] - i) % MODULUS
        length = np.zeros(len(i), np.int64)
        active = np.arange(len(i))
        for step in range(MODULUS):
            go_on = active[steps[active] > step]
            same = self.words[i[go_on] + step] == self.words[j[go_on] + step]
            length[go_on[same]] += 1
            active = go_on[same]
        reached = np.flatnonzero(length == steps)
        x, y = (self._sample(p[reached] + steps[reached]) for p in (i, j))
        first, last = np.minimum(self.rank[x], self.rank[y]), np.maximum(self.rank[x], self.rank[y])
        level = np.frexp((last - first).astype(np.float64))[1] - 1
        length[reached] += np.minimum(self.table[level, first], self.table[level, last - (1 << level)])
        return length

    def _sample(self, position: np.ndarray) -> np.ndarray:
        return position // MODULUS * len(COVER) + self.place[position % MODULUS]


def find_runs(words: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All runs of texts that lie one behind the other: text number, start in it, length, smallest period.

    ``words`` holds numbers from 0, ``sizes`` the words of each text. Ordered by text, start and period.
    """
    base = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    text, period, at = _candidates(words, sizes, base)
    if not len(text):
        return (np.zeros(0, np.int64),) * 4
    # only texts with a candidate are sorted
    kept, text = np.unique(text, return_inverse=True)
    sizes = sizes[kept]
    moved = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
    sequence = np.empty(int((sizes + 1).sum()), np.int64)
    inner = np.ones(len(sequence), bool)
    inner[moved + sizes] = False
    sequence[moved + sizes] = words.max() + 1 + np.arange(len(kept))  # an end that is found nowhere else
    sequence[inner] = words[np.repeat(base[kept] - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(int(sizes.sum()))]

    i = moved[text] + at
    ahead = Extensions(sequence).lengths(i, i + period)
    last = len(sequence)
    behind = Extensions(np.append(sequence[::-1], sequence.max() + 1)).lengths(last - i, last - i - period)
    start, length = at - behind, behind + ahead + period
    right = length >= np.maximum(MIN_WORDS, 2 * period)
    text, start, length, period = text[right], start[right], length[right], period[right]
    order = np.lexsort((period, length, start, text))
    text, start, length, period = text[order], start[order], length[order], period[order]
    # the same stretch with several periods: the smallest is its period
    first = np.ones(len(text), bool)
    first[1:] = (text[1:] != text[:-1]) | (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    text, start, length, period = text[first], start[first], length[first], period[first]
    order = np.lexsort((period, start, text))
    return kept[text[order]], start[order], length[order], period[order]


def _candidates(words: np.ndarray, sizes: np.ndarray, base: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Grid points that a run may hold: text number, period and position in the text.

    A run of period q has at least max(q, 12 - q) places in a row where the word q places on is the same, so
    points may be that far apart. They are at least six: at a point, four match from it on or three before it.
    """
    periods = np.where(sizes >= MIN_WORDS, sizes // 2, 0)
    pairs = np.concatenate([[0], np.cumsum(periods)])
    found = []
    for first, last in _portions(pairs, GRID_POINTS // 8):
        text = np.searchsorted(pairs, np.arange(first, last), "right") - 1
        period = np.arange(first, last) - pairs[text] + 1
        pitch = np.maximum(period, MIN_WORDS - period)
        points = np.concatenate([[0], np.cumsum((sizes[text] - 1 - period) // pitch + 1)])
        for a, b in _portions(points, GRID_POINTS, whole=True):
            pair = np.repeat(np.arange(a, b), np.diff(points[a : b + 1]))
            at = (np.arange(points[a], points[b]) - points[pair]) * pitch[pair]
            i = base[text[pair]] + at
            like = np.flatnonzero(words[i] == words[i + period[pair]])
            pair, at, i = pair[like], at[like], i[like]
            q, size, origin = period[pair], sizes[text[pair]], base[text[pair]]
            after = at + q + 3 < size
            before = at >= 3
            for step in (1, 2, 3):
                near = np.minimum(i + step + q, origin + size - 1)
                after &= words[np.minimum(i + step, near)] == words[near]
                near = np.maximum(i - step, origin)
                before &= words[near] == words[near + q]
            keep = after | before
            found.append((text[pair[keep]], q[keep], at[keep]))
    return tuple(np.concatenate(part) for part in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 3


def _portions(bounds: np.ndarray, size: int, whole: bool = False) -> Iterator[tuple[int, int]]:
    """Cut 0..bounds[-1] into ranges of ``size``; with ``whole``, ranges of entries that come to about ``size``."""
    if not whole:
        yield from ((at, min(at + size, int(bounds[-1]))) for at in range(0, int(bounds[-1]), size))
        return
    at = 0
    while at < len(bounds) - 1:
        end = max(int(np.searchsorted(bounds, bounds[at] + size, "right")) - 1, at + 1)
        yield at, end
        at = end


def collapse(size: int, start: np.ndarray, length: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Which of ``size`` words stay: those that no run contains after its first period."""
    change = np.zeros(size + 1, np.int64)
    np.add.at(change, start + period, 1)
    np.add.at(change, start + length, -1)
    return np.cumsum(change[:-1]) == 0


def periodic_runs(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, ``runs`` and ``collapsed`` of every row of ``docs`` (doc_id, text).

    A run is a stretch of words with smallest period q, at least ``MIN_WORDS`` and 2 q words long, that no
    neighbouring word extends; runs are ordered by start, then period. ``collapsed`` joins, by one space, the
    words that no run contains after its first q words. Words are cut at ASCII white space. NULL and empty
    texts have no words, no runs and an empty ``collapsed``. Rows are looked at one by one: repeated rows,
    equal texts and NULL ids stay as they are, an empty table gives none, other columns are ignored. A very
    long text is looked at whole and alone; memory grows with its words.
    """

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id")
            texts = [t.split() for t in batch.column("text").cast(pa.binary()).to_pylist()]  # bytes: ASCII white space
            total = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
            for first, last in _portions(total, CHUNK_WORDS, whole=True):
                runs, collapsed = _search(texts[first:last])
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(first, last - first), pa.array(np.diff(total[first : last + 1]), pa.int64()), runs, collapsed],
                    ["doc_id", "n_words", "runs", "collapsed"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(search, f"doc_id {kind}, n_words long, runs {RUNS}, collapsed string")


def _search(texts: list[list[bytes]]) -> tuple[pa.Array, pa.Array]:
    sizes = np.array([len(t) for t in texts], np.int64)
    number: dict[bytes, int] = {}
    words = np.fromiter((number.setdefault(w, len(number)) for t in texts for w in t), np.int64, int(sizes.sum()))
    text, start, length, period = find_runs(words, sizes)
    bounds = np.searchsorted(text, np.arange(len(texts) + 1))
    left = []
    for n, (a, b) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
        stay = texts[n]
        if b > a:
            keep = collapse(len(stay), start[a:b], length[a:b], period[a:b])
            stay = [stay[k] for k in np.flatnonzero(keep)]
        left.append(b" ".join(stay))
    runs = pa.ListArray.from_arrays(
        pa.array(bounds, pa.int32()), pa.StructArray.from_arrays([pa.array(v, pa.int64()) for v in (start, length, period)], ["start", "length", "period"]))
    return runs, pa.array(left, pa.binary()).cast(pa.string())


def planted(docs: DataFrame) -> DataFrame:
    """doc_id and text of ``docs``, where one document in ten repeats its last part.

    With h the CRC-32 of the id as text and g = h div 10: where 10 divides h, each word i from a = g mod n on is word
    a + (i - a) mod p, p = 1 + (n - a) div (3 + g mod 8). A NULL id or text is left as it is.
    """
    words = F.filter(F.split("text", "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    rows = docs.select("doc_id", "text", crc.alias("crc"), F.when(crc % 10 == 0, words).alias("words"))
    rows = rows.withColumn("n", F.size("words")).withColumn("g", F.expr("crc div 10"))
    rows = rows.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    rows = rows.withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    repeated = F.expr("array_join(transform(sequence(0, n - 1), i -> words[int(if(i < a, i, a + (i - a) % p))]), ' ')")
    return rows.select("doc_id", F.when((F.col("crc") % 10 == 0) & (F.col("n") > 0), repeated).otherwise(F.col("text")).alias("text"))


def run_report(docs: DataFrame) -> DataFrame:
    """Per document: number of runs, the greatest one, and digests of all runs and of the text without them."""
    greatest = F.expr("array_max(transform(runs, r -> struct(r.length, -r.start AS back, -r.period AS least)))")
    lines = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')")
    rows = periodic_runs(docs).withColumn("top", F.when(F.size("runs") > 0, greatest))
    return rows.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("top.back")).alias("start"), F.col("top.length").alias("length"),
        (-F.col("top.least")).alias("period"), F.expr("1000 * top.length div -top.least").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
