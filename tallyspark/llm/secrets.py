"""Secret scans with a trigram inverted index.

Each rule's regular expression is parsed and turned into a Boolean query over trigrams that any match must
contain. Blocks of documents get an inverted index of the trigrams that occur in queries: postings are
intersected and united, and only the candidates that are left are verified with the expression itself.
Rules without mandatory trigrams scan every text. Postings stay beside the texts of their block, so that
candidates are verified where they are and no text is moved.
"""

from __future__ import annotations

import functools
import hashlib
import re
import re._constants as sre
import re._parser as parser
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK = 4 << 20  # bytes of text that share an index
MOST_STRINGS = 64  # alternatives that are told apart while a query is derived


@dataclass(frozen=True)
class Rule:
    """``pattern`` is searched leftmost and non-overlapping; matches whose ``group`` is shorter than ``least`` are dropped."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


#: The base rules, in the order in which their kinds are listed.
BASE = (
    Rule("assign", r"""((?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16),
    Rule("hex", r"[0-9a-f]+", 0, 32),
)
#: Rules of our own, listed after the base.
MORE = (
    Rule("private_key", r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----"),
    Rule("code_host", r"gh[pousr]_[A-Za-z0-9]{36}"),
    Rule("signed_token", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"),
)

#: A query: None (anything matches), a trigram, or ("and" | "or", frozenset of queries).
Query = None | str | tuple


def _join(kind: str, parts: list[Query]) -> Query:
    if kind == "or" and any(p is None for p in parts):
        return None
    parts = [p for p in parts if p is not None]
    flat = frozenset(q for p in parts for q in (p[1] if isinstance(p, tuple) and p[0] == kind else [p]))
    return None if not flat else next(iter(flat)) if len(flat) == 1 else (kind, flat)


def _trigrams(strings: set[str]) -> Query:
    """Some string of the set occurs: all trigrams of one of them."""
    return _join("or", [_join("and", [s[i : i + 3] for i in range(len(s) - 2)]) for s in strings])


def _fold(c: int) -> str:
    return chr(c).lower() if c < 128 else chr(c)


def _walk(tree) -> tuple[set[str] | None, Query]:
    """The strings a part can match (folded; None if there are too many) and the query that any match meets."""
    exact: set[str] | None = {""}
    queries: list[Query] = []

    def close() -> None:
        nonlocal exact
        if exact is not None:
            queries.append(_trigrams(exact))
        exact = None

    for op, arg in tree:
        if op is sre.LITERAL:
            strings, own = {_fold(arg)}, None
        elif op is sre.IN and (letters := _letters(arg)) is not None:
            strings, own = letters, None
        elif op is sre.SUBPATTERN:
            strings, own = _walk(arg[-1])
        elif op is sre.BRANCH:
            ways = [_walk(t) for t in arg[1]]
            own = _join("or", [q if s is None else _trigrams(s) for s, q in ways])
            strings = None if any(s is None for s, _ in ways) else set().union(*(s for s, _ in ways))
        elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT):
            least, most, part = arg
            inner, query = _walk(part)
            own = (query if inner is None else _trigrams(inner)) if least else None
            strings = {""} | inner if (least, most) == (0, 1) and inner is not None else inner if (least, most) == (1, 1) else None
        else:
            strings, own = None, None
        if strings is None:
            close()
            queries.append(own)
            exact = {""}
            continue
        if exact is not None and len(exact) * len(strings) <= MOST_STRINGS:
            exact = {a + b for a in exact for b in strings}
        else:
            close()
            exact = set(strings)
        if own is not None:
            queries.append(own)
    complete = exact if not queries else None
    close()
    return complete, _join("and", queries)


def _letters(items) -> set[str] | None:
    """The folded characters of a small class."""
    out: set[str] = set()
    for op, arg in items:
        if op is sre.LITERAL:
            out.add(_fold(arg))
        elif op is sre.RANGE and arg[1] - arg[0] < 8:
            out.update(_fold(c) for c in range(arg[0], arg[1] + 1))
        else:
            return None
    return out if len(out) <= 8 else None


@functools.cache
def trigram_query(pattern: str) -> Query:
    """Boolean query over lower-case trigrams that every match of ``pattern`` meets; None if there is none."""
    return _walk(parser.parse(pattern))[1]


def _leaves(query: Query) -> set[str]:
    return set() if query is None else {query} if isinstance(query, str) else set().union(*(_leaves(q) for q in query[1]))


class Index:
    """Postings of one block: for each trigram of interest, the rows that have it."""

    def __init__(self, folded: bytes, starts: np.ndarray, trigrams: list[str]):
        codes = np.frombuffer(folded, np.uint8)
        keys = [int.from_bytes(t.encode("latin-1", "replace"), "big") for t in trigrams]
        self.postings = {t: np.zeros(0, np.int64) for t in trigrams}
        if len(codes) < 3:
            return
        wanted = np.zeros(1 << 16, bool)
        wanted[[k >> 8 for k in keys]] = True
        pairs = (codes[:-2].astype(np.uint16) << np.uint16(8)) | codes[1:-1]
        at = np.flatnonzero(wanted[pairs])
        grams = (pairs[at].astype(np.int32) << 8) | codes[at + 2]
        for t, k in zip(trigrams, keys, strict=True):
            rows = np.searchsorted(starts, at[grams == k], "right") - 1
            self.postings[t] = np.unique(rows)

    def rows(self, query: Query) -> np.ndarray:
        if isinstance(query, str):
            return self.postings[query]
        found = [self.rows(q) for q in query[1]]
        return functools.reduce(np.intersect1d if query[0] == "and" else np.union1d, found)


_FOLD = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
Span = tuple[int, int]


def search(rule: Rule, text: str) -> list[Span]:
    """Matches in one text."""
    return [m.span() for m in re.compile(rule.pattern).finditer(text) if len(m.group(rule.group)) >= rule.least]


def _runs(rule: Rule) -> Callable[[np.ndarray], np.ndarray] | None:
    """For a rule that is one repeated class of ASCII characters: a scan for its long runs."""
    tree = parser.parse(rule.pattern)
    if len(tree) != 1 or tree[0][0] is not sre.MAX_REPEAT or rule.group or tree[0][1][1] is not sre.MAXREPEAT:
        return None
    one = tree[0][1][2]
    if len(one) != 1 or one[0][0] is not sre.IN or any(op is not sre.RANGE or arg[1] > 127 for op, arg in one[0][1]):
        return None
    inside = np.zeros(256, bool)
    for _, (a, b) in one[0][1]:
        inside[a : b + 1] = True
    least = max(rule.least, tree[0][1][0])

    def scan(codes: np.ndarray) -> np.ndarray:
        """Starts and ends of runs, as rows."""
        # a long run covers a whole stretch between two marks
        step = max(1, least // 2)
        marked = inside[codes[::step]]
        if not (marked[1:] & marked[:-1]).any():
            return np.zeros((0, 2), np.int64)
        hit = np.concatenate([[False], inside[codes], [False]])
        ends = np.flatnonzero(hit[1:] != hit[:-1]).reshape(-1, 2)
        return ends[ends[:, 1] - ends[:, 0] >= least]

    return scan


def scan_block(texts: list[str], rules: tuple[Rule, ...]) -> list[list[tuple[int, int, int]]]:
    """Spans (start, number of the rule, end) of each text, sorted."""
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    data = b"\n".join(raw)
    starts = np.cumsum([0] + [len(r) + 1 for r in raw])[:-1]
    queries = [trigram_query(r.pattern) for r in rules]
    index = Index(data.translate(_FOLD), starts, sorted(set().union(*map(_leaves, queries))))
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for n, (rule, query) in enumerate(zip(rules, queries, strict=True)):
        if query is None and (scan := _runs(rule)):
            for a, b in scan(np.frombuffer(data, np.uint8)):
                row = int(np.searchsorted(starts, a, "right")) - 1
                first = len(raw[row][: a - starts[row]].decode("utf-8", "surrogatepass"))
                out[row].append((first, n, first + int(b - a)))
            continue
        for row in range(len(texts)) if query is None else index.rows(query):
            out[row] += [(a, n, b) for a, b in search(rule, texts[row])]
    return [sorted(spans) for spans in out]


def scan(docs: DataFrame, base: tuple[Rule, ...] = BASE, more: tuple[Rule, ...] = MORE) -> DataFrame:
    """doc_id, n_<kind> for each base rule, base_sha256 and spans of every row of ``docs`` (doc_id, text).

    Spans are kind:start:end in code points, end exclusive, by start and then rule, joined by commas;
    ``base_sha256`` is taken over those of the base rules. NULL and empty texts have no spans. Rows are
    scanned one by one, so repeated rows and NULL ids stay as they are; other columns are ignored.
    """
    rules = (*base, *more)

    def blocks(texts: list[str]) -> Iterator[list[str]]:
        block, size = [], 0
        for t in texts:
            block.append(t)
            size += len(t)
            if size >= BLOCK:
                yield block
                block, size = [], 0
        if block:
            yield block

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: list[list[int]] = [[] for _ in base]
            digests, strings = [], []
            for block in blocks(batch.column("text").to_pylist()):
                for spans in scan_block(block, rules):
                    for n, column in enumerate(counts):
                        column.append(sum(k == n for _, k, _ in spans))
                    named = [(k, f"{rules[k].kind}:{a}:{b}") for a, k, b in spans]
                    digests.append(hashlib.sha256(",".join(s for k, s in named if k < len(base)).encode()).hexdigest())
                    strings.append(",".join(s for _, s in named))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in counts), pa.array(digests, pa.string()), pa.array(strings, pa.string())],
                ["doc_id", *(f"n_{r.kind}" for r in base), "base_sha256", "spans"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, " + ", ".join(f"n_{r.kind} long" for r in base) + ", base_sha256 string, spans string"
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(run, schema)
