"""Byte-pair encoding by prefix dynamic programming, vectorised over many words.

A tokenizer's splitting rule is applied to whole batches with class tables and run boundaries. Every
distinct word is then encoded once: the encoding of a prefix is the encoding of a shorter prefix
plus the one token that may follow its last token, so a single pass leaves the exact count and
the last token of every prefix. No merge is ever replayed.

The tables are made from a tokenizer file of the ``tokenizers`` library. Strings of its special
tokens inside a text are one token each, as that library does by default.
"""

from __future__ import annotations

import functools
import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np

MULTIPLIER = np.uint64(0x9E3779B97F4A7C15 | 1)
LONG_WORD = 48  # longer words are encoded one by one, in the same way
SLICE = 1 << 20  # characters handled at once
KEEP_WORDS = 2_000_000  # distinct words remembered by a worker before it starts afresh
LETTER, NUMBER, SPACE, OTHER = 1, 2, 3, 4


def _powers(n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    if n > 1:
        out[1:] = MULTIPLIER
        np.multiply.accumulate(out, out=out)
    return out


@functools.cache
def _salt() -> np.ndarray:
    """A random 64-bit value for each symbol: bytes, and bytes that end a word."""
    return np.random.default_rng(20240607).integers(1, 2**63, 512, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


@functools.cache
def _classes() -> np.ndarray:
    """Letter, number, white space or other, for each code point."""
    out = np.full(0x110000, OTHER, np.uint8)
    for c in range(0x110000):
        kind = unicodedata.category(chr(c))[0]
        if kind == "L":
            out[c] = LETTER
        elif kind == "N":
            out[c] = NUMBER
    out[[*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]] = SPACE
    return out


@functools.cache
def _byte_names() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    names = {chr(b): b for b in plain}
    for n, b in enumerate(b for b in range(256) if b not in set(plain)):
        names[chr(256 + n)] = b
    return names


class HashTable:
    """64-bit keys to int32 values, open addressing; -1 where a key is absent."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.bits = max(12, int(len(keys) * 4).bit_length())
        self.keys, self.values = np.zeros(1 << self.bits, np.uint64), np.full(1 << self.bits, -1, np.int32)
        self.shift, self.mask = np.uint64(64 - self.bits), np.int64((1 << self.bits) - 1)
        # a small filter that turns most absent keys away without leaving the cache
        self.seen_shift = np.uint64(64 - self.bits - 2)
        self.seen = np.zeros(1 << (self.bits + 2), bool)
        self.seen[((keys * np.uint64(0xD6E8FEB86659FD93)) >> self.seen_shift).view(np.int64)] = True
        at, todo, self.probes = self._slot(keys), np.arange(len(keys)), 0
        while len(todo):
            self.probes += 1
            free = self.values[at[todo]] < 0
            slots, first = np.unique(at[todo[free]], return_index=True)
            won = todo[free][first]
            self.keys[slots], self.values[slots] = keys[won], values[won]
            todo = np.setdiff1d(todo, won)
            at[todo] = (at[todo] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0xD6E8FEB86659FD93)) >> self.shift).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys * np.uint64(0xD6E8FEB86659FD93)
        out = np.full(len(keys), -1, np.int32)
        todo = np.flatnonzero(self.seen[(mixed >> self.seen_shift).view(np.int64)])
        at, keys = (mixed[todo] >> self.shift).view(np.int64), keys[todo]
        for _ in range(self.probes):
            value = self.values[at]
            same = self.keys[at] == keys
            out[todo[same]] = value[same]
            more = ~same & (value >= 0)
            if not more.any():
                break
            todo, at, keys = todo[more], (at[more] + 1) & self.mask, keys[more]
        return out


class Tokenizer:
    """Counts and ids as the library gives them, for whole batches of texts."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.end = model["end_of_word_suffix"] or ""
        self.lower = spec["normalizer"] is not None
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special = re.compile("(" + "|".join(map(re.escape, self.specials)) + ")") if self.specials else None
        vocab = model["vocab"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        # rank: 0 for single symbols, then the order of merges; a token is made by the merge that gives it first
        top = max(vocab.values()) + 1
        self.rank = np.zeros(top, np.int64)
        self.left, self.right = np.arange(top), np.arange(top)
        pairs, made = [], []
        for n, (a, b) in enumerate(merges, 1):
            i = vocab[a + b]
            if not self.rank[i]:
                self.rank[i], self.left[i], self.right[i] = n, vocab[a], vocab[b]
                pairs.append((vocab[a] << 32) | vocab[b])
                made.append(n)
        self.merge = HashTable(np.array(pairs, np.uint64), np.array(made, np.int32))
        names, hashes, ids, self.longest = _byte_names(), [], [], 1
        self.single = np.full(512, -1, np.int64)
        for token, i in vocab.items():
            if token in self.specials:
                continue
            ends = bool(self.end) and token.endswith(self.end) and token != self.end
            symbols = [names[c] for c in (token[: -len(self.end)] if ends else token)]
            if len(symbols) > 1 and not self.rank[i]:
                continue  # no merge leads there
            if ends:
                symbols[-1] += 256
            if len(symbols) == 1:
                self.single[symbols[0]] = i
            self.longest = max(self.longest, len(symbols))
            s = _salt()[symbols]
            hashes.append(np.uint64((s * _powers(len(s))).sum(dtype=np.uint64) + np.uint64(len(s))))
            ids.append(i)
        self.vocab = HashTable(np.array(hashes, np.uint64), np.array(ids, np.int32))
        self.inverse = np.uint64(pow(int(MULTIPLIER), -1, 1 << 64))
        self.forget()

    def forget(self) -> None:
        self.known, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.starts, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int32)

    # -- which token may follow which -------------------------------------------------------------

    def may_follow(self, first: np.ndarray, then: np.ndarray) -> np.ndarray:
        """Whether the text of the two tokens is encoded as just these two.

        Both are undone merge by merge, latest first; a merge across the border that comes before
        the one undone last would have been done instead.
        """
        a, b = first.astype(np.int64), then.astype(np.int64)
        limit, ok = np.full(len(a), 1 << 40), np.ones(len(a), bool)
        live = np.arange(len(a))
        while len(live):
            x, y = a[live], b[live]
            across = self.merge.get((x.astype(np.uint64) << np.uint64(32)) | y.astype(np.uint64))
            bad = (across > 0) & (across < limit[live])
            ok[live[bad]] = False
            live, x, y = live[~bad], x[~bad], y[~bad]
            rx, ry = self.rank[x], self.rank[y]
            # the later merge is undone; of equal ones the left was done first, so the right goes first
            undo_left = rx > ry
            done = (rx == 0) & (ry == 0)
            limit[live] = np.where(undo_left, rx, ry + 1)
            a[live], b[live] = np.where(undo_left, self.right[x], x), np.where(undo_left, y, self.left[y])
            live = live[~done]
        return ok

    # -- one pass over the prefixes of many words ----------------------------------------------------

    def prefixes(self, symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Count of tokens and last token of every prefix, as matrices of words by prefix length.

        ``symbols`` is a matrix of words, padded with anything on the right; the last symbol of a word is its
        word-end form where the vocabulary has these, so inner prefixes are those of an unended word.
        """
        n, width = symbols.shape
        power = _powers(width + 1)
        inverse = np.ones(width + 1, np.uint64)
        inverse[1:] = self.inverse
        np.multiply.accumulate(inverse, out=inverse)
        sums = np.zeros((n, width + 1), np.uint64)
        np.cumsum(_salt()[symbols] * power[:width], axis=1, out=sums[:, 1:])
        count, last = np.zeros((n, width + 1), np.int32), np.full((n, width + 1), -1, np.int32)
        for e in range(1, width + 1):
            open_ = np.flatnonzero(lengths >= e)
            for size in range(min(e, self.longest), 0, -1):
                if not len(open_):
                    break
                s = e - size
                token = self.vocab.get((sums[open_, e] - sums[open_, s]) * inverse[s] + np.uint64(size))
                hit = token >= 0
                rows, token = open_[hit], token[hit]
                if s and len(rows):
                    pairs = (last[rows, s].astype(np.uint64) << np.uint64(32)) | token.astype(np.uint64)
                    pairs, back = np.unique(pairs, return_inverse=True)
                    fits = self.may_follow(pairs >> np.uint64(32), pairs & np.uint64(0xFFFFFFFF))[back]
                    rows, token = rows[fits], token[fits]
                count[rows, e], last[rows, e] = count[rows, s] + 1, token
                open_ = open_[last[open_, e] < 0]
        return count, last

    def long_prefixes(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same for one long word, prefix by prefix."""
        n = len(symbols)
        sums = np.zeros(n + 1, np.uint64)
        inverse = np.full(n + 1, self.inverse, np.uint64)
        inverse[0] = 1
        np.multiply.accumulate(inverse, out=inverse)
        np.cumsum(_salt()[symbols] * _powers(n), out=sums[1:])
        count, last = np.zeros(n + 1, np.int64), np.full(n + 1, -1, np.int64)
        memo: dict[tuple[int, int], bool] = {}
        for e in range(1, n + 1):
            s = np.arange(max(0, e - self.longest), e)
            tokens = self.vocab.get((sums[e] - sums[s]) * inverse[s] + (e - s).astype(np.uint64))
            for k in np.flatnonzero(tokens >= 0):
                pair = (int(last[s[k]]), int(tokens[k]))
                if s[k] and pair not in memo:
                    memo[pair] = bool(self.may_follow(np.array([pair[0]]), np.array([pair[1]]))[0])
                if not s[k] or memo[pair]:
                    count[e], last[e] = count[s[k]] + 1, pair[1]
                    break
        return count, last

    @functools.cached_property
    def _lengths(self) -> np.ndarray:
        """Symbols of each token."""
        out = np.ones(len(self.rank), np.int64)
        for i in np.argsort(self.rank, kind="stable"):
            if self.rank[i]:
                out[i] = out[self.left[i]] + out[self.right[i]]
        return out

    def _learn(self, hashes: np.ndarray, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, want_ids: bool) -> None:
        """Encode distinct new words, given as slices of ``data``, and remember them."""
        counts = np.zeros(len(hashes), np.int64)
        if len(self.known) > KEEP_WORDS:
            self.forget()
        begins, found, filled = np.zeros(len(hashes), np.int64), [], len(self.ids)
        order = np.argsort(lengths, kind="stable")
        at = 0
        while at < len(order):
            longest = int(lengths[order[at]])
            if longest > LONG_WORD:
                k = order[at]
                count, last = self.long_prefixes(self._symbols(data[starts[k] : starts[k] + lengths[k]][None, :], lengths[k : k + 1])[0])
                counts[k] = count[-1]
                if want_ids:
                    ids, e = [], int(lengths[k])
                    while e:
                        ids.append(last[e])
                        e -= int(self._lengths[last[e]])
                    found.append(np.array(ids[::-1], np.int32))
                    begins[k], filled = filled, filled + len(ids)
                at += 1
                continue
            stop = int(np.searchsorted(lengths[order], min(longest + 4, LONG_WORD), "right"))
            stop = min(stop, at + 20_000)
            part = order[at:stop]
            width = int(lengths[part].max())
            index = np.minimum(starts[part][:, None] + np.arange(width), len(data) - 1)
            count, last = self.prefixes(self._symbols(data[index], lengths[part]), lengths[part])
            counts[part] = count[np.arange(len(part)), lengths[part]]
            if want_ids:
                most = int(counts[part].max())
                ids, e, rows = np.zeros((len(part), most), np.int32), lengths[part].copy(), np.arange(len(part))
                left = counts[part].copy()
                while len(live := np.flatnonzero(left > 0)):
                    token = last[rows[live], e[live]]
                    left[live] -= 1
                    ids[live, left[live]] = token
                    e[live] -= self._lengths[token]
                found.append(ids[np.arange(most) < counts[part][:, None]])
                ends = filled + np.cumsum(counts[part])
                begins[part], filled = ends - counts[part], int(ends[-1])
            at = stop
        self.ids = np.concatenate([self.ids, *found])
        at = np.searchsorted(self.known, hashes)  # hashes come sorted
        self.known, self.counts, self.starts = np.insert(self.known, at, hashes), np.insert(self.counts, at, counts), np.insert(self.starts, at, begins)

    def _symbols(self, block: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        block = block.astype(np.int16)
        if self.end:
            block[np.arange(len(block)), lengths - 1] += 256
        return block

    # -- words of a text ---------------------------------------------------------------------------

    def normal(self, text: str) -> str:
        if not self.lower:
            return text
        text = unicodedata.normalize("NFC", text) if not text.isascii() else text
        return text.replace("Σ", "σ").lower()  # character by character: no final sigma

    def words(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and end of every word of a text given as code points."""
        n = len(codes)
        kind = _classes()[codes]
        new = np.ones(n, bool)
        new[1:] = kind[1:] != kind[:-1]
        if self.lower:  # numbers are words of their own
            new |= kind == NUMBER
        starts = np.flatnonzero(new)
        # an apostrophe of its own, without a space that belongs to it, takes s t m d re ve ll along
        ends = np.append(starts[1:], n)
        alone = (codes[starts] == 39) & (ends - starts == 1) & (ends < n)
        if not self.lower:
            alone &= ~((starts > 0) & (codes[np.maximum(starts - 1, 0)] == 32))
        shift = np.zeros(len(starts), np.int64)
        for k in np.flatnonzero(alone):
            a, b = int(codes[ends[k]]), int(codes[ends[k] + 1]) if ends[k] + 1 < n else -1
            if a in (115, 116, 109, 100):
                shift[k] = 1
            elif (a, b) in ((114, 101), (118, 101), (108, 108)):
                shift[k] = 2
        if shift.any():
            moved = shift[:-1] > 0
            starts[1:][moved] += shift[:-1][moved]
            ends[shift > 0] += shift[shift > 0]
            keep = starts < ends
            starts, ends = starts[keep], ends[keep]
        space = kind[starts] == SPACE
        if self.lower:
            return starts[~space], ends[~space]
        # a last blank before a word belongs to the word; another last white space is a word of its own
        inner = space & (ends < n)
        last_blank = inner & (codes[np.maximum(ends - 1, 0)] == 32)
        before = np.zeros(len(starts), bool)
        before[1:] = last_blank[:-1]
        starts = np.where(before, starts - 1, starts)
        ends = np.where(last_blank, ends - 1, ends)
        cut = inner & ~last_blank & (ends - starts > 1)
        if cut.any():
            extra = ends[cut] - 1
            ends = np.where(cut, ends - 1, ends)
            starts, ends = np.concatenate([starts, extra]), np.concatenate([ends, extra + 1])
            order = np.argsort(starts, kind="stable")
            starts, ends = starts[order], ends[order]
        keep = starts < ends
        return starts[keep], ends[keep]

    def slices(self, text: str) -> Iterator[tuple[str, int]]:
        """Parts that can be encoded on their own: (text, -1), or ("", id of a special token)."""
        for n, part in enumerate(self.special.split(text) if self.special and "<|" in text else [text]):
            if n % 2:
                yield "", self.specials[part]
                continue
            part, at = self.normal(part), 0
            while len(part) - at > SLICE:  # white space after a word always begins a word
                m = _BORDER.search(part, at + SLICE - 1)
                if not m:
                    break
                yield part[at : m.start() + 1], -1
                at = m.start() + 1
            yield part[at:], -1

    def encode(self, texts: list[str], want_ids: bool = True) -> tuple[np.ndarray, np.ndarray | None]:
        """Token count of each text, and all ids in order (None unless wanted)."""
        counts, ids = np.zeros(len(texts), np.int64), []
        pending: list[tuple[int, str, int]] = []
        size = 0
        for row, text in enumerate(texts):
            for part, special in self.slices(text):
                pending.append((row, part, special))
                size += len(part)
                if size >= SLICE:
                    self._encode(pending, counts, ids if want_ids else None)
                    pending, size = [], 0
        self._encode(pending, counts, ids if want_ids else None)
        return counts, (np.concatenate([*ids, np.zeros(0, np.int32)]) if want_ids else None)

    def _encode(self, parts: list[tuple[int, str, int]], counts: np.ndarray, ids: list | None) -> None:
        if not parts:
            return
        # parts are joined with a special code point that no word crosses
        word_row, starts, ends, base, specials = [], [], [], 0, []
        pieces = []
        for k, (_, part, special) in enumerate(parts):
            if special >= 0:
                specials.append((k, special))
                continue
            if not part:
                continue
            codes = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), np.uint32)
            s, e = self.words(codes)
            raw = np.frombuffer(part.encode("utf-8", "surrogatepass"), np.uint8)
            if len(raw) != len(codes):
                at = np.concatenate([np.flatnonzero((raw & 0xC0) != 0x80), [len(raw)]])
                s, e = at[s], at[e]
            pieces.append(raw)
            starts.append(s + base)
            ends.append(e + base)
            word_row.append(np.full(len(s), k))
            base += len(raw)
        part_counts = np.zeros(len(parts), np.int64)
        if pieces:
            data, s, e, k = np.concatenate(pieces), np.concatenate(starts), np.concatenate(ends), np.concatenate(word_row)
            sums = np.zeros(len(data) + 1, np.uint64)
            np.cumsum(_salt()[data] * _power_to(len(data)), out=sums[1:])
            hashes = (sums[e] - sums[s]) * _inverse_to(self.inverse, len(data))[s] + (e - s).astype(np.uint64)
            unique, first, back = np.unique(hashes, return_index=True, return_inverse=True)
            at = np.searchsorted(self.known, unique)
            new = (at == len(self.known)) | (self.known[np.minimum(at, len(self.known) - 1)] != unique) if len(self.known) else np.ones(len(unique), bool)
            if new.any():
                before = len(self.known)
                self._learn(unique[new], data, s[first[new]], (e - s)[first[new]], ids is not None)
                if len(self.known) < before + int(new.sum()):  # it has started afresh
                    rest = ~new
                    if rest.any():
                        self._learn(unique[rest], data, s[first[rest]], (e - s)[first[rest]], ids is not None)
                at = np.searchsorted(self.known, unique)
            word_counts = self.counts[at][back]
            part_counts += np.bincount(k, word_counts, len(parts)).astype(np.int64)
            if ids is not None:
                begin = self.starts[at][back]
                ends_at = np.cumsum(word_counts)
                index = np.arange(int(ends_at[-1]) if len(ends_at) else 0) + np.repeat(begin - (ends_at - word_counts), word_counts)
                flat = self.ids[index]
        elif ids is not None:
            flat = np.zeros(0, np.int32)
        for k, _ in specials:
            part_counts[k] += 1
        np.add.at(counts, [row for row, _, _ in parts], part_counts)
        if ids is not None:
            if specials:
                offsets = np.cumsum(part_counts)
                places = [int(offsets[k]) - 1 - n for n, (k, _) in enumerate(specials)]
                flat = np.insert(flat, places, [i for _, i in specials])
            ids.append(flat)


_BORDER = re.compile(r"\S[ \n]")
_CACHE: dict[str, np.ndarray] = {}


def _power_to(n: int) -> np.ndarray:
    if len(_CACHE.get("power", ())) < n:
        _CACHE["power"] = _powers(n + SLICE)
    return _CACHE["power"][:n]


def _inverse_to(inverse: np.uint64, n: int) -> np.ndarray:
    if len(_CACHE.get("inverse", ())) < n:
        out = np.full(n + SLICE, inverse, np.uint64)
        out[0] = 1
        _CACHE["inverse"] = np.multiply.accumulate(out)
    return _CACHE["inverse"][: n + 1]


def forget_powers() -> None:
    _CACHE.clear()


@functools.lru_cache(maxsize=4)
def tokenizer(path: str) -> Tokenizer:
    """One per worker and file: what a worker has encoded serves its later tasks."""
    return Tokenizer(path)
