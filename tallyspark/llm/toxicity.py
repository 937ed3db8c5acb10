"""Toxicity by a bidirectional gated recurrent network with attention pooling, trained in numpy.

A word enters as its own hashed vector and the mean of the hashed vectors of its character sequences. Windows of
words overlap and cover the whole text; each is read in both directions, its states are pooled by attention, and the
text's score is that of its worst window. Training follows the same rule: a document's gradient goes
through the window that decides it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.llm import bpe

WINDOW, STRIDE = 64, 48  # words
HIDDEN, EMBED, ROWS = 8, 12, 1 << 14
CHARACTERS = (3, 4, 5)
TRAIN_TOXIC, TRAIN_CLEAN, TRAIN_CHARS = 1500, 2500, 12_000  # bound of the labelled sample: rows of each class, longest text
EPOCHS, STEPS, BATCH, RATE = 9, 300, 64, 0.01  # small samples are read more often, until so many steps are made
THRESHOLD = 0.3
LINES = 1024  # windows scored at once
BYTES = 1 << 20  # text prepared at once
WORDS = 1 << 14  # distinct words read at once

_LOWER = np.array([c + 32 if 65 <= c <= 90 else c for c in range(256)], np.uint8)
_WORD = np.array([c >= 128 or chr(c).isalnum() for c in range(256)])


def words(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of several texts: bytes, start and end of each distinct word, number of each word in reading order, words per text."""
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    data = _LOWER[np.frombuffer(b"\n".join(raw) + b"\n", np.uint8)]
    inside = np.concatenate([[False], _WORD[data]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    hashes = _window_hash(data, starts, ends)
    unique, first, number = np.unique(hashes, return_index=True, return_inverse=True)
    limits = np.cumsum([len(r) + 1 for r in raw])
    upto = np.searchsorted(starts, limits)
    return data, starts[first], ends[first], number.astype(np.int32), np.diff(upto, prepend=0)


def _sums(data: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(bpe._salt()[data] * bpe._power_to(len(data)), out=sums[1:])
    return sums


_INVERSE = np.uint64(pow(int(bpe.MULTIPLIER), -1, 1 << 64))


def _window_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    sums = _sums(data)
    return (sums[ends] - sums[starts]) * bpe._inverse_to(_INVERSE, len(data))[starts] + (ends - starts).astype(np.uint64)


def _row(hashes: np.ndarray) -> np.ndarray:
    return ((hashes * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(64 - ROWS.bit_length() + 1)).astype(np.int64)


def features(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each distinct word: its row, and the rows of its character sequences as (rows, first of each word)."""
    lengths = ends - starts + 2
    begins = np.cumsum(lengths) - lengths
    marked = np.full(int(lengths.sum()), 32, np.uint8)  # a blank before and after each word
    owner = np.repeat(np.arange(len(starts)), lengths)
    place = np.arange(len(marked)) - begins[owner]
    inner = (place > 0) & (place < lengths[owner] - 1)
    marked[inner] = data[(starts[owner] + place - 1)[inner]]
    sums, inverse = _sums(marked), bpe._inverse_to(_INVERSE, len(marked))
    rows, owners = [], []
    for n in CHARACTERS:
        at = np.flatnonzero(place + n <= lengths[owner])
        rows.append(_row((sums[at + n] - sums[at]) * inverse[at] + np.uint64(n)))
        owners.append(owner[at])
    whole = np.flatnonzero(lengths < CHARACTERS[0])
    rows.append(np.zeros(len(whole), np.int64))
    owners.append(whole)
    rows_, owners_ = np.concatenate(rows), np.concatenate(owners)
    order = np.argsort(owners_, kind="stable")
    return _row(_window_hash(data, starts, ends)), rows_[order], np.searchsorted(owners_[order], np.arange(len(starts)))


def windows(count: int) -> np.ndarray:
    """First words of the windows of a text: every word is in one, neighbours overlap."""
    return np.arange(0, max(1, count - WINDOW + STRIDE), STRIDE)[: max(1, -(-(count - WINDOW) // STRIDE) + 1)]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return np.float32(0.5) * np.tanh(np.float32(0.5) * x) + np.float32(0.5)


@dataclass
class Network:
    """Arrays of the network: vectors of words and character sequences, input and state weights by direction, attention, output."""

    p: dict[str, np.ndarray]

    @classmethod
    def new(cls, seed: int = 1) -> Network:
        r = np.random.default_rng(seed)
        f = lambda *shape, scale=0.3: (r.standard_normal(shape) * scale).astype(np.float32)
        h, e = HIDDEN, 2 * EMBED
        # vectors start near zero, so that a word never seen says nothing
        return cls({"word": f(ROWS, EMBED, scale=0.02), "char": f(ROWS, EMBED, scale=0.02), "in": f(e, 6 * h), "bias": np.zeros(6 * h, np.float32), "ahead": f(h, 3 * h), "back": f(h, 3 * h),
                    "key": f(2 * h, h), "query": f(h), "out": f(2 * h), "off": np.full(1, -1, np.float32)})

    def inputs(self, word: np.ndarray, char: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Vectors of distinct words, and what they give to the gates."""
        many = np.diff(np.append(first, len(char))).astype(np.float32)[:, None]
        x = np.hstack([self.p["word"][word], np.add.reduceat(self.p["char"][char], first, axis=0) / np.maximum(many, 1)]) if len(word) else np.zeros((0, 2 * EMBED), np.float32)
        return x, x @ self.p["in"] + self.p["bias"]

    def gates(self, ready: Prepared) -> np.ndarray:
        """What all words give to the gates, some words at a time, and a row for places after the end."""
        out = np.zeros((len(ready.word) + 1, 6 * HIDDEN), np.float32)
        bounds = np.append(ready.first, len(ready.char))
        for at in range(0, len(ready.word), WORDS):
            end = min(at + WORDS, len(ready.word))
            out[at:end] = self.inputs(ready.word[at:end], ready.char[bounds[at] : bounds[end]], bounds[at:end] - bounds[at])[1]
        return out

    def read(self, gates: np.ndarray, ids: np.ndarray, keep: bool = False):
        """Logit of each window. ``ids`` has a window a row, -1 where it is over."""
        h, (n, length) = HIDDEN, ids.shape
        states = np.zeros((length, n, 2 * h), np.float32)
        trace = []
        live = (ids >= 0).astype(np.float32)
        for side, name in enumerate(("ahead", "back")):
            own, u = np.ascontiguousarray(gates[:, 3 * h * side : 3 * h * (side + 1)]), self.p[name]
            state = np.zeros((n, h), np.float32)
            for t in range(length) if side == 0 else range(length - 1, -1, -1):
                x, s = own[ids[:, t]], state @ u
                zr = _sigmoid(x[:, : 2 * h] + s[:, : 2 * h])
                z, r = zr[:, :h], zr[:, h:]
                new = np.tanh(x[:, 2 * h :] + r * s[:, 2 * h :])
                step = (1 - z) * live[:, t, None]
                following = state + step * (new - state)
                if keep:
                    trace.append((side, t, state, s, z, r, new))
                state = following
                states[t, :, side * h : (side + 1) * h] = state
        keys = np.tanh(states @ self.p["key"])
        weight = keys @ self.p["query"]
        weight = np.where(live.T > 0, weight, -1e9)
        weight = np.exp(weight - weight.max(axis=0))
        weight /= weight.sum(axis=0)
        pooled = np.einsum("tn,tnh->nh", weight, states)
        logit = pooled @ self.p["out"] + self.p["off"][0]
        return (logit, states, keys, weight, pooled, trace, live) if keep else logit

    def gradient(self, kept, dlogit: np.ndarray, gates: np.ndarray, ids: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray]:
        """Gradients of the network's arrays and of ``gates``."""
        _, states, keys, weight, pooled, trace, live = kept
        h, p = HIDDEN, self.p
        g = {k: np.zeros_like(v) for k, v in p.items() if k not in ("word", "char", "in", "bias")}
        g["off"][0], g["out"] = dlogit.sum(), pooled.T @ dlogit
        dpooled = dlogit[:, None] * p["out"]
        dweight = np.einsum("nh,tnh->tn", dpooled, states)
        dstates = weight[:, :, None] * dpooled
        dscore = weight * (dweight - (weight * dweight).sum(axis=0))
        g["query"] = np.einsum("tnh,tn->h", keys, dscore)
        dkeys = dscore[:, :, None] * p["query"] * (1 - keys**2)
        g["key"] = np.einsum("tna,tnb->ab", states, dkeys)
        dstates = dstates + dkeys @ p["key"].T
        dgates = np.zeros_like(gates)
        after = {0: np.zeros((ids.shape[0], h), np.float32), 1: np.zeros((ids.shape[0], h), np.float32)}
        for side, t, state, s, z, r, new in reversed(trace):
            name = ("ahead", "back")[side]
            d = dstates[t, :, side * h : (side + 1) * h] + after[side]
            on = live[:, t, None]
            step = (1 - z) * on
            dnew = d * step * (1 - new**2)
            dz = -d * on * (new - state) * z * (1 - z)
            dr = dnew * s[:, 2 * h :] * r * (1 - r)
            ds = np.hstack([dz, dr, dnew * r])
            g[name] += state.T @ ds
            after[side] = d * (1 - step) + ds @ p[name].T
            rows = ids[:, t] >= 0
            np.add.at(dgates[:, 3 * h * side : 3 * h * (side + 1)], ids[rows, t], np.hstack([dz, dr, dnew])[rows])
        return g, dgates


@dataclass
class Prepared:
    """Texts ready to be read: features of their distinct words, and their windows as rows of word numbers."""

    word: np.ndarray
    char: np.ndarray
    first: np.ndarray
    ids: np.ndarray
    owner: np.ndarray  # text of each window
    names: np.ndarray  # digests of the distinct words


def prepare(texts: list[str]) -> Prepared:
    data, starts, ends, number, counts = words(texts)
    word, char, first = features(data, starts, ends)
    names = _window_hash(data, starts, ends)
    begin = np.cumsum(counts) - counts
    firsts = [windows(int(c)) for c in counts]
    owner = np.repeat(np.arange(len(texts)), [len(f) for f in firsts])
    at = np.concatenate([*firsts, np.zeros(0, np.int64)])[:, None] + np.arange(WINDOW)
    there = at < counts[owner][:, None]
    if not len(number):
        return Prepared(word, char, first, np.full(at.shape, -1, np.int32), owner, names)
    index = np.minimum(begin[owner][:, None] + at, len(number) - 1)
    return Prepared(word, char, first, np.where(there, number[index], -1).astype(np.int32), owner, names)


def portions(texts: list[str]) -> Iterator[list[int]]:
    """Numbers of texts that come to about ``BYTES`` characters together."""
    group, size = [], 0
    for i, t in enumerate(texts):
        group.append(i)
        size += len(t)
        if size >= BYTES:
            yield group
            group, size = [], 0
    if group:
        yield group


def prepare_parts(texts: list[str]) -> Prepared:
    """As ``prepare``, one portion at a time: only the words and windows of the others are held meanwhile."""
    known: dict[int, int] = {}
    parts, sizes = [], []
    for group in portions(texts):
        ready, before = prepare([texts[i] for i in group]), len(known)
        number = np.array([known.setdefault(n, len(known)) for n in ready.names.tolist()], np.int32)
        new, many = number >= before, np.diff(np.append(ready.first, len(ready.char)))
        ids = np.where(ready.ids >= 0, number[ready.ids], np.int32(-1)) if len(number) else ready.ids
        parts.append((ready.word[new], ready.char[np.repeat(new, many)].astype(np.int32), ids, ready.owner + group[0], ready.names[new]))
        sizes.append(many[new])
    bpe.forget_powers()  # as long as a portion
    word, char, ids, owner, names = (np.concatenate(p) for p in zip(*parts, strict=True))
    many = np.concatenate(sizes)
    return Prepared(word, char, np.cumsum(many) - many, ids, owner, names)


def logits(network: Network, texts: list[str]) -> np.ndarray:
    """Largest logit over the windows of each text."""
    out = np.full(len(texts), -np.inf, np.float32)
    for group in portions(texts):
        ready = prepare([texts[i] for i in group])
        gates = network.gates(ready)
        for at in range(0, len(ready.ids), LINES):
            np.maximum.at(out, np.array(group)[ready.owner[at : at + LINES]], network.read(gates, ready.ids[at : at + LINES]))
    return out


def fit(texts: list[str], labels: np.ndarray, seed: int = 1) -> Network:
    """Train on labelled texts. Without examples of both kinds the network says no to everything alike."""
    network, r = Network.new(seed), np.random.default_rng(seed)
    labels = np.asarray(labels, np.float32)
    if len(texts) == 0 or labels.min() == labels.max():
        network.p["out"][:] = 0
        return network
    ready = prepare_parts(texts)
    first_window = np.searchsorted(ready.owner, np.arange(len(texts)))
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in network.p.items()}
    clock = 0
    for epoch in range(max(EPOCHS, STEPS // max(1, -(-len(texts) // BATCH)))):
        # which window decides: at first any, then the worst by the network so far
        if epoch == 0:
            value = r.random(len(ready.ids)).astype(np.float32)
        else:
            gates = network.gates(ready)
            value = np.concatenate([network.read(gates, ready.ids[a : a + LINES]) for a in range(0, len(ready.ids), LINES)])
        order = np.lexsort((-value, ready.owner))
        chosen = order[first_window]
        if epoch == 0:  # a random second window of each text helps to start
            extra = order[np.minimum(first_window + 1, len(order) - 1)]
            picks, targets = np.concatenate([chosen, extra]), np.concatenate([labels, labels[ready.owner[extra]]])
        else:
            picks, targets = chosen, labels
        turn = r.permutation(len(picks))
        for a in range(0, len(turn), BATCH):
            part = picks[turn[a : a + BATCH]]
            target = targets[turn[a : a + BATCH]]
            used, ids = np.unique(ready.ids[part], return_inverse=True)
            ids = ids.reshape(len(part), WINDOW) - (used[0] < 0)
            used = used[used >= 0]
            many = np.diff(np.append(ready.first, len(ready.char)))[used]
            first = np.cumsum(many) - many
            char = ready.char[np.arange(int(many.sum())) + np.repeat(ready.first[used] - first, many)]
            word = ready.word[used]
            x, gates = network.inputs(word, char, first)
            gates = np.vstack([gates, np.zeros((1, gates.shape[1]), np.float32)])
            kept = network.read(gates, ids, keep=True)
            slope = ((_sigmoid(kept[0]) - target) / len(part)).astype(np.float32)
            grad, dgates = network.gradient(kept, slope, gates, ids)
            dgates = dgates[:-1]
            grad["in"], grad["bias"] = x.T @ dgates, dgates.sum(axis=0)
            dx = dgates @ network.p["in"].T
            grad["word"], grad["char"] = np.zeros_like(network.p["word"]), np.zeros_like(network.p["char"])
            np.add.at(grad["word"], word, dx[:, :EMBED])
            np.add.at(grad["char"], char, np.repeat(dx[:, EMBED:] / np.maximum(many, 1)[:, None], many, axis=0))
            clock += 1
            for k, v in network.p.items():
                m, s = moments[k]
                m += np.float32(0.1) * (grad[k] - m)
                s += np.float32(0.01) * (grad[k] ** 2 - s)
                rate = RATE * np.sqrt(1 - 0.99**clock) / (1 - 0.9**clock)
                v -= (np.float32(rate) * m / (np.sqrt(s) + np.float32(1e-7))).astype(np.float32)
    return network


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learnt from."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 4 == 2


def train(docs: DataFrame, labels: DataFrame, seed: int = 1) -> Network:
    """Fit on labelled rows that are not held out.

    The sample is bounded: at most ``TRAIN_TOXIC`` toxic and ``TRAIN_CLEAN`` clean rows in the order of a hash of doc_id,
    with texts of at most ``TRAIN_CHARS`` characters. Only text and label of a row are used.
    """
    known = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).where(~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull())
    order = [F.xxhash64("doc_id"), "doc_id"]
    ids = known.where("toxic = 1").orderBy(*order).limit(TRAIN_TOXIC).union(known.where("toxic = 0").orderBy(*order).limit(TRAIN_CLEAN))
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).where(F.length("text") <= TRAIN_CHARS)
    rows = (texts.join(F.broadcast(ids), "doc_id")  # bounded by the sample's size
            .orderBy(*order, "toxic", "text").limit(TRAIN_TOXIC + TRAIN_CLEAN).select("text", "toxic").toPandas())
    return fit(rows["text"].tolist(), rows["toxic"].to_numpy(), seed)


def score(docs: DataFrame, network: Network) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of ``docs`` (doc_id, text).

    NULL and empty texts are one empty window, scored like any other. Rows are scored one by one, so repeated rows
    and NULL ids (never held out unless the hash of no text says so) stay; other columns are no inputs.
    """
    shared = docs.sparkSession.sparkContext.broadcast(network.p)  # a fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Network(shared.value)
        for batch in batches:
            value = logits(own, batch.column("text").to_pylist()).astype(np.float64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(1 / (1 + np.exp(-value)))], ["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(run, f"doc_id {kind}, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, network: Network) -> DataFrame:
    """The rows of ``docs``, all columns, that score below the threshold."""
    shared = docs.sparkSession.sparkContext.broadcast(network.p)
    low = float(np.log(THRESHOLD / (1 - THRESHOLD)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Network(shared.value)
        for batch in batches:
            value = logits(own, [t or "" for t in batch.column("text").to_pylist()])
            yield batch.filter(pa.array(value < low))

    return docs.mapInArrow(run, docs.schema)
