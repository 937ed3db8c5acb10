"""Main text of web pages from their structure and the suffix array of their host.

A page is read into blocks. Structure tells what they are: what lies in menus, headers, footers, forms, adverts
and the like goes, what lies in an article is its text, the rest is open. The suffix array of the host decides on open blocks and
on those at the ends of articles: the token streams of a host's distinct pages are put together and their suffixes
sorted, and neighbours with a long common prefix are repeats. What enough pages have is boilerplate, unique runs stay.

A host is dealt into pieces of bounded size, each with a suffix array of its own. A run that a share of a host's pages have is
had by that share of some piece's pages, so the pieces name all runs that may be boilerplate; where a host has
several pieces, those are counted again over all of its pages.
"""

from __future__ import annotations

import html
import json
import re
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.session import staged

FEW = 1_000_000  # hosts or runs that are broadcast
PIECE = 8 << 20  # characters of html in a piece of a host
RUN = 10  # tokens of the shortest repeat that counts, unless it is a whole block
PAGES, SHARE = 3, 0.3  # distinct pages of a host, and their share, that have to have a run
COVERED = 0.6  # share of a block's tokens in repeated runs from which it is boilerplate
HEAD = 5  # tokens of a run in the plain version on joins, which `extract` does not use
EDGE = 3  # blocks at either end of an article that may be boilerplate

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S)
_MARK = re.compile(r"""(?:^|\s)(class|id|role|hidden|aria-hidden)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_BLANK = re.compile(r"\s+")
_NAME = re.compile(r"[a-z]+")
# Fixed values of HTML: elements whose content is no text, elements without an end, elements that don't break a line.
_RAW = frozenset("script style noscript template svg math iframe object canvas textarea title select audio video head".split())
_VERBATIM = frozenset("script style textarea title iframe noscript".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark meter nobr output q rp rt ruby s samp small span strike strong sub sup "
    "time tt u var wbr".split())
_CHROME = frozenset("nav header footer aside form menu dialog button fieldset".split())
_CHROME_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion nav navigation navbar menu header masthead footer sidebar side widget "
    "cookie cookies consent gdpr notice notices alert popup modal overlay comment comments disqus respond reply replies share sharing social related recommended newsletter subscribe signup "
    "login breadcrumb breadcrumbs pagination pager toolbar search copyright disclaimer legal".split())
_CHROME_ROLES = frozenset("navigation banner contentinfo complementary search menu menubar dialog alertdialog alert form".split())
_MAIN = frozenset("article main".split())
_CLOSES_P = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
KEEP, OPEN, DROP = 2, 1, 0
NAMED = -1  # dropped for a class or id alone; blocks have DROP for it


def _role(name: str, attributes: str, inside: int) -> int:
    """What an element makes of its blocks, inside one of the given kind."""
    if inside == DROP or name in _RAW:
        return DROP
    if name in _CHROME and not (name == "header" and inside == KEEP):
        return DROP
    main = name in _MAIN
    named = False
    if attributes:
        for m in _MARK.finditer(attributes):
            key, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
            if key == "hidden" or key == "aria-hidden" and value == "true" or key == "role" and value in _CHROME_ROLES:
                return DROP
            if key in ("class", "id") and name not in ("html", "body", *_MAIN) and any(
                    part in _CHROME_NAMES for word in value.split() for part in (word, *_NAME.findall(word))):
                named = True
            if key == "role" and value in ("main", "article"):
                main = True
    return KEEP if main else NAMED if named else inside


def blocks(page: str) -> list[tuple[int, str]]:
    """Blocks of a page in order, as (DROP, OPEN or KEEP, text): references decoded, white space single, trimmed, not empty.

    Elements without an end tag end with the element around them; an unfinished tag at the end is none of the text.
    """
    out: list[tuple[int, str]] = []
    stack: list[tuple[str, int]] = []
    parts: list[str] = []
    state, at, n = OPEN, 0, len(page)

    def flush() -> None:
        if parts:
            text = _BLANK.sub(" ", html.unescape("".join(parts))).strip()
            if text:
                out.append((max(state, DROP), text))
            parts.clear()

    while at < n:
        m = _TAG.search(page, at)
        end = m.start() if m else n
        if end > at:
            parts.append(page[at:end])
        if not m:
            break
        at = m.end()
        name = (m[2] or "").lower()
        if not name:
            continue
        if name not in _INLINE:
            flush()
        elif name in ("br", "wbr", "img"):
            parts.append(" " if name == "br" else "")
        if m[1]:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    if state != (stack[k - 1][1] if k else OPEN):
                        flush()
                    del stack[k:]
                    break
        elif name in _VOID or m[3].endswith("/") and name not in ("p", "div", "a", "span", "li"):
            continue
        else:
            if name in _CLOSES_P and any(t == "p" for t, _ in stack):
                k = max(i for i, (t, _) in enumerate(stack) if t == "p")
                if not any(t in ("article", "section", "div", "td", "li", "aside", "nav") for t, _ in stack[k + 1 :]):
                    del stack[k:]
            elif name in ("li", "dt", "dd", "option", "tr", "td", "th") and stack and stack[-1][0] == name:
                stack.pop()
            now = stack[-1][1] if stack else OPEN
            role = _role(name, m[3], now)
            if role != now:
                flush()
            if name in _VERBATIM:
                stop = re.compile(rf"</{name}\s*>", re.I).search(page, at)
                at = stop.end() if stop else n
                continue
            stack.append((name, role))
        state = stack[-1][1] if stack else OPEN
    flush()
    return out


def read_blocks(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url, host, length (of the html), copy (a digest of its blocks), roles and texts of its blocks."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [blocks(h) for h in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("page_id", "url", "host")), pa.array([len(h) for h in batch.column("html").to_pylist()], pa.int64()),
                 pa.array([[r for r, _ in b] for b in found], pa.list_(pa.int32())),
                 pa.array([[t for _, t in b] for b in found], pa.list_(pa.string()))], ["page_id", "url", "host", "length", "roles", "texts"])

    rows = pages.select("page_id", "url", F.lower(F.coalesce(F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/@]*@)?([^/:?#]+)", 1), F.lit(""))).alias("host"),
                        F.coalesce("html", F.lit("")).alias("html"))
    kinds = {f.name: f.dataType.simpleString() for f in pages.schema}
    read_ = rows.mapInArrow(read, f"page_id {kinds['page_id']}, url {kinds['url']}, host string, length long, roles array<int>, texts array<string>")
    return read_.withColumn("copy", F.xxhash64("roles", "texts"))


def suffixes(found: DataFrame, run: int = HEAD) -> DataFrame:
    """host, page, block, role, position and the digest of the ``run`` tokens from there, for all blocks outside articles.

    Blocks in menus, footers and the like take part: they tell what a host repeats. A block shorter
    than a run is one suffix of its own.
    """
    block = found.select("host", "page", F.posexplode(F.arrays_zip("roles", "texts")).alias("block", "b")).where(F.col("b.roles") < KEEP)
    words = block.select("host", "page", "block", F.col("b.roles").alias("role"), F.split(F.lower("b.texts"), " ").alias("words"))
    words = words.withColumn("tokens", F.size("words"))
    heads = F.expr(f"transform(sequence(0, greatest(size(words) - {run}, 0)), i -> xxhash64(array_join(slice(words, i + 1, {run}), ' ')))")
    return words.select("host", "page", "block", "role", "tokens", F.least(F.size("words"), F.lit(run)).alias("length"), F.posexplode_outer(heads).alias("position", "head"))


def repeated(order: DataFrame) -> DataFrame:
    """host and head of suffixes that more than one page of a host has.

    Pages are compared by least and greatest, which is reduced in each task, so no page is ever collected.
    """
    return order.groupBy("host", "head").agg(F.min("page").alias("first"), F.max("page").alias("last")).where(F.col("first") < F.col("last")).select("host", "head")


def covered(order: DataFrame, runs: DataFrame, long: int = 0) -> DataFrame:
    """page, block and the tokens of it that lie in repeated stretches of ``long`` tokens, or of the whole block, for open blocks."""
    hits = order.where(F.col("role") == OPEN).join(runs, ["host", "head"], "left_semi").select("page", "block", "tokens", "position", (F.col("position") + F.col("length")).alias("stop")).distinct()
    before = Window.partitionBy("page", "block").orderBy("position").rowsBetween(Window.unboundedPreceding, -1)
    until = Window.partitionBy("page", "block").orderBy("position").rowsBetween(Window.unboundedPreceding, 0)
    apart = F.col("position") > F.coalesce(F.max("stop").over(before), F.lit(-1))
    stretches = hits.withColumn("apart", apart.cast("int")).withColumn("stretch", F.sum("apart").over(until))
    whole = stretches.groupBy("page", "block", "stretch").agg((F.max("stop") - F.min("position")).alias("covered"), F.first("tokens").alias("tokens"))
    return whole.where(F.col("covered") >= F.least(F.lit(long), F.col("tokens"))).groupBy("page", "block").agg(F.sum("covered").alias("covered"))


class Streams:
    """Token streams of pages, one after another: for each token its code, the end of its block, its page and where it may count."""

    def __init__(self, pages: list[tuple[list[int], list[str]]], run: int = RUN) -> None:
        split = [(n, r, e, t.lower().split(" ")) for n, (roles, texts) in enumerate(pages) for r, e, t in zip(roles, _edges(roles), texts, strict=True)]
        sizes = np.array([len(w) for *_, w in split], dtype=np.int64)
        self.codes, words = pd.factorize(np.array([x for *_, w in split for x in w], dtype=object))
        self.codes = self.codes.astype(np.int64)
        digests = np.array([int.from_bytes(blake2b(w.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little") for w in words], dtype=np.uint64)
        self.tokens = digests[self.codes] if len(words) else np.zeros(0, np.uint64)
        self.ends = np.repeat(np.cumsum(sizes), sizes)
        self.page, self.role, self.edge = (np.repeat(np.array([b[c] for b in split], dtype=np.int64), sizes) for c in range(3))
        at = np.arange(len(self.codes))
        begins = self.ends - np.repeat(sizes, sizes)
        self.left = self.ends - at
        # A run begins where it has room in its block; a shorter block is one run.
        self.begins = (self.left >= run) | (at == begins)
        self.run = run
        self.sizes = sizes

    def digest(self, at: np.ndarray) -> np.ndarray:
        """A digest of the run that begins at each of the positions, the same in every task."""
        length = np.minimum(self.left[at], self.run)
        out = length.astype(np.uint64) * np.uint64(_ODD[-1])
        for k in range(self.run):
            inside = k < length
            out[inside] += self.tokens[at[inside] + k] * np.uint64(_ODD[k % len(_ODD)] + 2 * k)
        return out.view(np.int64)


_ODD = tuple(int.from_bytes(blake2b(bytes([k]), digest_size=8).digest(), "little") >> 1 | 1 for k in range(32))


def _edges(roles: list[int]) -> list[bool]:
    """For each block whether it lies at an end of the article."""
    article = [k for k, r in enumerate(roles) if r == KEEP]
    ends = {*article[:EDGE], *article[-EDGE:]}
    return [k in ends for k in range(len(roles))]


def suffix_array(codes: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Positions in the order of the suffixes that begin there, each up to the end of its block; by doubling of ranks.

    Suffixes that are alone with their rank are in place; a round sorts the others by the rank of what follows.
    """
    order = np.argsort(codes, kind="stable")
    slots = np.arange(len(codes))
    first = np.concatenate([[True], codes[order][1:] != codes[order][:-1]])[: len(codes)]
    rank = np.empty_like(slots)
    rank[order] = np.maximum.accumulate(np.where(first, slots, 0))
    length = 1
    while len(slots):
        ranks = rank[order[slots]]
        same = ranks[1:] == ranks[:-1]
        slots = slots[np.concatenate([[False], same]) | np.concatenate([same, [False]])]
        at = order[slots]
        follow = np.where(at + length < ends[at], rank[np.minimum(at + length, len(codes) - 1)] + 1, 0)
        key = rank[at] * (len(codes) + 1) + follow
        turn = np.argsort(key, kind="stable")
        at, key = at[turn], key[turn]
        order[slots] = at
        head = np.concatenate([[True], key[1:] != key[:-1]])[: len(key)]
        ranks = slots[np.maximum.accumulate(np.where(head, np.arange(len(key)), 0))]
        if np.array_equal(ranks, rank[at]):
            break  # what is left is equal to its end
        rank[at] = ranks
        length *= 2
    return order


def common_prefixes(order: np.ndarray, codes: np.ndarray, ends: np.ndarray, most: int) -> np.ndarray:
    """Tokens, ``most`` at most, that each suffix in order shares with the one before it."""
    out = np.zeros(max(len(order) - 1, 0), dtype=np.int64)
    going = np.arange(len(out))
    for k in range(most):
        a, b = order[going] + k, order[going + 1] + k
        inside = (a < ends[order[going]]) & (b < ends[order[going + 1]])
        going, a, b = going[inside], a[inside], b[inside]
        going = going[codes[a] == codes[b]]
        out[going] += 1
    return out


def repeats(pages: list[tuple[list[int], list[str]]], least: int, run: int = RUN) -> list[tuple[int, int, int, bool]]:
    """Runs that ``least`` of the given distinct pages have: digest, pages, pages that have it at an end of their article, whether it may be judged by that.

    Longer repeats are chains of these: each page that has one has all runs in it.
    """
    s = Streams(pages, run)
    order = suffix_array(s.codes, s.ends)
    alike = common_prefixes(order, s.codes, s.ends, run)
    length = np.minimum(s.left[order], run)
    class_ = np.concatenate([[0], np.cumsum((alike < length[1:]) | (length[1:] != length[:-1]))])[: len(order)]
    class_, at = class_[s.begins[order]], order[s.begins[order]]
    many = np.bincount(class_)[class_] >= least if len(class_) else np.zeros(0, bool)
    class_, at = class_[many], at[many]

    def owners(some: np.ndarray) -> np.ndarray:
        pairs = np.unique(class_[some] * len(pages) + s.page[at[some]])
        return np.bincount(pairs // max(len(pages), 1), minlength=class_.max(initial=-1) + 1)

    every, edges = owners(np.ones(len(at), bool)), owners(s.edge[at] > 0)
    judged = np.bincount(class_, weights=(s.role[at] == OPEN) | (s.edge[at] > 0), minlength=len(every)) > 0
    kinds, one = np.unique(class_, return_index=True)
    kinds, one = kinds[every[kinds] >= least], one[every[kinds] >= least]
    return list(zip(s.digest(at[one]).tolist(), every[kinds].tolist(), edges[kinds].tolist(), judged[kinds].tolist(), strict=True))


def _pieces(found: DataFrame, piece: int) -> DataFrame:
    """host and pieces of the hosts that have more than one."""
    number = F.ceil(F.sum("length") / F.lit(piece)).cast("int")
    return staged(found.groupBy("host").agg(number.alias("pieces")).where("pieces > 1"), "pieces")


def _small(table: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(table) if rows <= FEW else table


def _candidates(found: DataFrame, run: int, share: float) -> DataFrame:
    """host, pieces, pages (distinct ones of a piece), and a run's digest, owners, edges and judged, of each piece; one row without a run for each piece."""

    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, seen = pa.Codec("zstd"), set()
        for batch in batches:
            out: dict[tuple, list] = {}
            for row in batch.to_pylist():
                if (row["host"], row["copy"]) not in seen:  # a copy is sent once by a task
                    seen.add((row["host"], row["copy"]))
                    out.setdefault((row["host"], row["pieces"], row["copy"] % row["pieces"]), []).append((row["copy"], row["roles"], row["texts"]))
            raw = [json.dumps(v).encode() for v in out.values()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[c] for k in out], t) for c, t in enumerate((pa.string(), pa.int32(), pa.int32()))]
                + [pa.array([len(r) for r in raw], pa.int64()), pa.array([codec.compress(r, asbytes=True) for r in raw], pa.binary())],
                ["host", "pieces", "piece", "size", "blob"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd")
        key, pages = None, {}

        def rows() -> pa.RecordBatch:
            # In a host of one piece the run is judged here; else it may be, if it has its share of this piece.
            least = max(int(np.ceil(share * len(pages) - 1e-9)), PAGES if key[1] == 1 else 1)
            got = [r for r in repeats(list(pages.values()), least, run) if key[1] > 1 or r[3]]
            got = [(None, 0, 0, False), *got]
            return pa.RecordBatch.from_arrays(
                [pa.array([key[0]] * len(got), pa.string()), pa.array([key[1]] * len(got), pa.int32()), pa.array([len(pages)] * len(got), pa.int64()),
                 *(pa.array([r[c] for r in got], t) for c, t in enumerate((pa.int64(), pa.int64(), pa.int64())))], ["host", "pieces", "pages", "run", "owners", "edges"])

        for batch in batches:
            for row in batch.to_pylist():
                if key != (row["host"], row["pieces"], row["piece"]):
                    if key:
                        yield rows()
                    key, pages = (row["host"], row["pieces"], row["piece"]), {}
                for copy, roles, texts in json.loads(codec.decompress(row["blob"], row["size"], asbytes=True)):
                    pages.setdefault(copy, (roles, texts))
        if key:
            yield rows()

    dealt = found.select("host", "pieces", "copy", "roles", "texts").mapInArrow(bundle, "host string, pieces int, piece int, size long, blob binary")
    grouped = dealt.repartition("host", "piece").sortWithinPartitions("host", "piece")
    return grouped.mapInArrow(search, "host string, pieces int, pages long, run long, owners long, edges long")


def _covered(page: tuple[list[int], list[str]], inner: list[int], edges: list[int], run: int) -> list[int]:
    """Tokens of each block that lie in the given runs: of open blocks in ``inner``, of those at the ends of the article in ``edges``."""
    s = Streams([page], run)
    at = np.flatnonzero(s.begins)
    digest = s.digest(at)
    hit = at[(np.isin(digest, np.array(inner, np.int64)) & (s.role[at] == OPEN)) | (np.isin(digest, np.array(edges, np.int64)) & (s.edge[at] > 0))]
    step = np.zeros(len(s.codes) + 1, dtype=np.int64)
    np.add.at(step, hit, 1)
    np.add.at(step, np.minimum(hit + run, s.ends[hit]), -1)
    inside = np.concatenate([[0], np.cumsum(np.cumsum(step)[:-1] > 0)])
    stops = np.cumsum(s.sizes)
    return (inside[stops] - inside[stops - s.sizes]).tolist()


def _counted(found: DataFrame, runs: DataFrame, run: int) -> DataFrame:
    """host, run, owners and edges of the given runs (host, run), over all distinct pages of their hosts; without those that only chrome has."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = []
            for row in batch.to_pylist():
                s = Streams([(row["roles"], row["texts"])], run)
                at = np.flatnonzero(s.begins)
                digest = s.digest(at)
                wanted = np.isin(digest, np.array(row["runs"], np.int64))
                at, digest = at[wanted], digest[wanted]
                edges, opened = set(digest[s.edge[at] > 0].tolist()), set(digest[s.role[at] == OPEN].tolist())
                got.append((row["host"], row["copy"], [{"run": r, "edge": int(r in edges), "open": int(r in opened)} for r in sorted(set(digest.tolist()))]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.int64()),
                 pa.array([g[2] for g in got], pa.list_(pa.struct([("run", pa.int64()), ("edge", pa.int32()), ("open", pa.int32())])))], ["host", "copy", "has"])

    lists = staged(runs.groupBy("host").agg(F.collect_set("run").alias("runs")), "runs")
    rows = found.join(_small(lists, runs.count()), "host").select("host", "copy", "roles", "texts", "runs")
    per_page = rows.mapInArrow(count, "host string, copy long, has array<struct<run: long, edge: int, open: int>>").dropDuplicates(["host", "copy"])
    counts = per_page.select("host", F.explode("has").alias("r")).groupBy("host", "r.run").agg(
        F.count(F.lit(1)).alias("owners"), F.sum("r.edge").alias("edges"), F.sum("r.open").alias("open"))
    return counts.where("open > 0 OR edges > 0").select("host", "run", "owners", "edges")


def boilerplate(found: DataFrame, run: int = RUN, share: float = SHARE, piece: int = PIECE) -> DataFrame:
    """host, inner and edges: runs that are boilerplate in open blocks, and those that are at the ends of articles.

    At least ``PAGES`` of a host's distinct pages must have them, and this share of all of them; at the ends of articles, have them there.
    """
    large = _pieces(found, piece)
    many = large.count()
    dealt = found.join(_small(large, many), "host", "left").withColumn("pieces", F.coalesce("pieces", F.lit(1)))
    named = staged(_candidates(dealt, run, share), "candidates")
    sizes = named.where("run IS NULL").groupBy("host").agg(F.sum("pages").alias("pages"))
    counts = named.where("run IS NOT NULL AND pieces = 1").select("host", "run", "owners", "edges")
    if many:
        counts = counts.unionByName(_counted(found.join(_small(large.select("host"), many), "host", "left_semi"),
                                             named.where("run IS NOT NULL AND pieces > 1").select("host", "run").distinct(), run))

    def common(number: str) -> Column:
        return F.collect_list(F.when((F.col(number) >= PAGES) & (F.col(number) >= share * F.col("pages")), F.col("run")))

    lists = counts.join(sizes, "host").groupBy("host").agg(common("owners").alias("inner"), common("edges").alias("edges"))
    return staged(lists.where("size(inner) > 0 OR size(edges) > 0"), "boilerplate")


def extract(pages: DataFrame, run: int = RUN, share: float = COVERED, piece: int = PIECE) -> DataFrame:
    """page_id, url, text and n_chars of every row of ``pages`` (page_id, url, html).

    If a page has blocks in an article or main element, they are its text, without what is marked
    as chrome inside; else it is the blocks outside of chrome. Blocks that are covered by runs which a share of their host's distinct
    pages have are left out, in articles only those at the ends, if as many pages have the runs there, and only if most of
    the article is not such runs. Pages with the same blocks are one page there.
    NULL html gives an empty text; pages without a readable host are compared with each other. Repeated rows, also with NULL
    ids, are pages of their own in the result, but one page when repeats are sought. Other columns are ignored.
    """

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for row in batch.to_pylist():
                page = row["roles"], row["texts"]
                covered = _covered(page, row["inner"], row["edges"], run)
                kind = KEEP if KEEP in page[0] else OPEN
                sizes = [len(t.split(" ")) for t in page[1]]
                own = [k for k, r in enumerate(page[0]) if r == kind]
                gone = {k for k in own if covered[k] >= share * sizes[k]}
                if kind == KEEP and 2 * sum(sizes[k] for k in gone) >= sum(sizes[k] for k in own):
                    gone = set()  # a copy of other articles
                texts.append("\n".join(page[1][k] for k in own if k not in gone))
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())], ["page_id", "url", "text"])

    found = staged(read_blocks(pages), "blocks")
    runs = boilerplate(found, run, SHARE, piece)
    number = runs.agg(F.sum(F.size("inner") + F.size("edges"))).first()[0]
    kind = f"CASE WHEN array_contains(roles, {KEEP}) THEN {KEEP} ELSE {OPEN} END"
    plain = F.array_join(F.expr(f"filter(texts, (t, i) -> roles[i] = {kind})"), "\n").alias("text")
    if not number:
        return found.select("page_id", "url", plain).withColumn("n_chars", F.length("text").cast("long"))
    out = found.join(_small(runs.select("host"), number), "host", "left_anti").select("page_id", "url", plain)
    kinds = {f.name: f.dataType.simpleString() for f in pages.schema}
    judged = found.join(_small(runs, number), "host").select("page_id", "url", "roles", "texts", "inner", "edges").mapInArrow(
        judge, f"page_id {kinds['page_id']}, url {kinds['url']}, text string")
    return out.unionByName(judged).withColumn("n_chars", F.length("text").cast("long"))
