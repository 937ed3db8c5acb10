"""Near-duplicate lines as an exact set-similarity join.

A line's tokens are the digests of its runs of five words. Lines with equal sets are one class. Two
sets with a Jaccard similarity of t share a token within the first n - ceil(t * n) + 1 of each, in any common order.

and with l more tokens in each they share l more. That is used twice. In the order of digests, which needs no statistics,
it sets aside the classes that share too few of these tokens with others: they match nothing. The rest are ordered by rarity, from exact
counts over all of their tokens, and joined on their rarest tokens, with bounds on length and position and on what bitmaps of
the sets leave in common, and verified.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.llm import bitmap
from tallyspark.session import discard, staged

SHINGLE, PERCENT = 5, 80
WORDS = 4  # 64-bit words of a set's bitmap
LAST = (1 << 63) - 1
PLACE = ("unnamed", "doc_id", "doc", "line")  # order of lines: documents by doc_id, without one last, then by line


def _named(docs: DataFrame) -> DataFrame:
    """doc_id, doc (a digest of doc_id and text) and text, never NULL."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.unhex(F.md5(F.concat_ws(" ", F.coalesce(F.col("doc_id").cast("string"), F.lit("?")), text))).alias("doc"), text.alias("text"))


def _cut(text: Column) -> Column:
    """The lines of a text, with a space for every other blank."""
    for blank in "\t\x0b\x0c\r":
        text = F.replace(text, F.lit(blank), F.lit(" "))
    return F.split(text, "\n")


def _once(rows: DataFrame, column: Column, name: str) -> DataFrame:
    """``rows`` with one more column, which is made once even if several others are made from it: a Project would be merged with theirs."""
    return rows.select("*", F.explode_outer(F.array(column)).alias(name))


def _with_tokens(rows: DataFrame, size: int) -> DataFrame:
    """``rows`` with the sorted distinct tokens of their ``row``, a line; none if it has fewer words."""
    run = f"xxhash64({', '.join(f'words[i + {k}]' for k in range(size))})"
    runs = F.expr(f"CASE WHEN size(words) >= {size} THEN transform(sequence(0, size(words) - {size}), i -> {run}) ELSE CAST(array() AS ARRAY<BIGINT>) END")
    found = _once(_once(rows, F.array_remove(F.split("row", " "), ""), "words"), runs, "runs")
    return _once(found, F.sort_array(F.array_distinct("runs")), "tokens").drop("row", "words", "runs")


def _least(n: Column, percent: int) -> Column:
    """Tokens that a set of ``n`` has in common with a similar one, at least."""
    return F.ceil(n * percent / 100)


def _prefix(percent: int) -> Column:
    return F.col("n") - _least(F.col("n"), percent) + 1


def _met(n: Column, percent: int) -> Column:
    """How many common tokens a set of ``n`` shows in its head; it never falls with ``n``."""
    return F.least(_least(n, percent), F.floor(n / 20) + 2)


def _lines(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """Lines with tokens: doc_id, doc, line, a and b (digests of the set), n (its size), head (short digests of the first tokens); and for each document one row with line -1, n its lines."""
    text = F.concat(F.array(F.lit("")), _cut(F.col("text")))
    # The outer form of explode: for the inner one Spark infers a filter that would cut the text again.
    cut = _once(_named(docs), text, "texts").select("doc_id", "doc", (F.size("texts") - 1).alias("lines"), F.posexplode_outer("texts").alias("at", "row"))
    cut = _with_tokens(cut.select("doc_id", "doc", "lines", (F.col("at") - 1).alias("line"), "row"), size)
    kept = cut.select("doc_id", "doc", "lines", "line", "tokens", F.size("tokens").alias("n"))
    shown = F.greatest(_prefix(percent) - 1 + _met(F.col("n"), percent), F.lit(0)).cast("int")
    head = F.transform(F.slice("tokens", 1, shown), lambda t: t.bitwiseAND(F.lit((1 << 31) - 1)).cast("int"))
    return kept.select(  # lines without tokens stay: a filter on them would be moved to where the tokens are made, and make them twice
        "doc_id", "doc", "line", F.xxhash64("tokens").alias("a"), F.hash("tokens").alias("b"),
        F.when(F.col("line") < 0, F.col("lines")).otherwise(F.col("n")).alias("n"), head.alias("head"))


def _sets(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """tokens of the wanted lines, cut again from their documents, and the columns of ``wanted`` (a, b, doc, line) but for the last two.

    A bitmap of places keeps most other lines where they are.
    """
    place = F.xxhash64("doc", "line")
    lines = _named(docs).select("doc", F.posexplode_outer(_cut(F.col("text"))).alias("line", "row")).withColumn("place", place)
    found = bitmap.likely(lines, wanted.withColumn("place", place), "place").drop("place").join(wanted, ["doc", "line"])
    # A repeated document once, before there are tokens: they would have to be moved for it.
    return _with_tokens(found.dropDuplicates(["doc", "line"]).drop("doc", "line"), size)


def _among(rows: DataFrame, tokens: DataFrame, how: str = "left_semi") -> DataFrame:
    """The rows whose token is in the table ``tokens``; with ``how`` "inner", and the other columns of that table.

    A bitmap of the tokens turns most others away before rows move.
    """
    return bitmap.likely(rows, tokens, "token").join(tokens, "token", how)


def _prefixes(sets: DataFrame, percent: int) -> DataFrame:
    """a, b, n, at, token and rank of the rarest tokens of each class, of which similar ones share one; others and bits.

    ``at`` is the doc_id of the class's first line, the greatest number if that has none. ``others`` is how many tokens of
    the set other classes have too, and ``bits`` has a bit for each of these, set if an odd number of them fall on it.
    """
    each = sets.select("a", "b", "n", "at", F.explode_outer("tokens").alias("token"))
    rarity = staged(each.groupBy("token").count().where("count > 1"), "rarity")
    rank = F.row_number().over(Window.partitionBy("a", "b").orderBy("count", "token"))
    whole = Window.partitionBy("a", "b")
    bit = F.expr("shiftleft(1L, CAST(token & 63 AS INT))")
    words = {f"bits{k}": F.bit_xor(F.when(F.pmod(F.shiftright("token", 6), F.lit(WORDS)) == k, bit).otherwise(F.lit(0).cast("long"))).over(whole) for k in range(WORDS)}
    rows = _among(each, rarity, "inner").withColumns({"rank": rank, "others": F.count(F.lit(1)).over(whole), **words})
    # Tokens that one class alone has come first in the order, but match nothing: they only move the others back.
    placed = rows.withColumn("rank", F.col("rank") + F.col("n") - F.col("others"))
    prefix = staged(placed.where(F.col("rank") <= _prefix(percent)).select("a", "b", "n", "at", "token", "rank", "others", F.struct(*words).alias("bits")), "prefixes")
    discard(rarity)
    return prefix


def _verified(later: DataFrame, earlier: DataFrame, order: Column, sets: DataFrame, percent: int) -> DataFrame:
    """Similar pairs (a, b, a2, b2) of two tables of prefixes whose ``at`` and ``at2`` are in the given order."""
    other = earlier.select(F.col("a").alias("a2"), F.col("b").alias("b2"), F.col("n").alias("n2"), "token", F.col("rank").alias("rank2"), F.col("at").alias("at2"), F.col("others").alias("others2"), F.col("bits").alias("bits2"))
    least = F.ceil((F.col("n") + F.col("n2")) * percent / (100 + percent))  # tokens two similar sets have in common
    length = (100 * F.least("n", "n2") >= percent * F.greatest("n", "n2"))
    position = 1 + F.least(F.col("n") - F.col("rank"), F.col("n2") - F.col("rank2")) >= least - F.least("rank", "rank2") + 1
    # Each bit that differs is a token of one set alone.
    alone = sum((F.bit_count(F.col(f"bits.bits{k}").bitwiseXOR(F.col(f"bits2.bits{k}"))) for k in range(WORDS)), F.lit(0))
    common = F.col("others") + F.col("others2") - alone >= 2 * least
    apart = (F.col("a") != F.col("a2")) | (F.col("b") != F.col("b2"))
    pairs = staged(later.join(other, "token").where(order & apart & length & position & common).select("a", "b", "a2", "b2").distinct(), "pairs")
    full = sets.select("a", "b", "tokens")
    full2 = full.select(F.col("a").alias("a2"), F.col("b").alias("b2"), F.col("tokens").alias("tokens2"))
    # Few sets are in a pair: the others stay where they are.
    both = pairs.join(bitmap.likely(full, pairs, "a"), ["a", "b"]).join(bitmap.likely(full2, pairs, "a2"), ["a2", "b2"])
    common = F.size(F.array_intersect("tokens", "tokens2"))
    return both.where(100 * common >= percent * (F.size("tokens") + F.size("tokens2") - common)).select("a", "b", "a2", "b2")


def later_classes(classes: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """Classes a, b that an earlier one is similar to, for a written table of classes (a, b, first, n, head).

    Each class meets the earliest class of each of its prefix tokens first, which is as many pairs as there are tokens;
    only classes that find no match there meet the others.
    """
    # Tokens that two classes have; then the classes that have enough of them. The smallest set that is similar shows
    # the fewest common tokens. Digests of 31 bits only set aside less.
    heads = classes.select("a", "b", "n", F.explode_outer("head").alias("token"))
    shared = staged(heads.groupBy("token").count().where("count > 1").select("token"), "shared")
    met = _among(heads, shared).groupBy("a", "b", "n").count()
    matched = met.where(F.col("count") >= _met(_least(F.col("n"), percent), percent)).select("a", "b")
    places = classes.select("a", "b", F.coalesce("first.doc_id", F.lit(LAST)).alias("at"), "first.doc", "first.line")
    wanted = staged(matched.join(places, ["a", "b"]), "wanted")
    written = staged(_sets(docs, wanted, size), "sets")
    discard(shared, wanted)
    sets = written.withColumn("n", F.size("tokens"))
    prefix = _prefixes(sets, percent)
    earliest = prefix.groupBy("token").agg(F.min(F.struct("at", "a", "b", "n", "rank", "others", "bits")).alias("e")).select("token", "e.*")
    found = staged(_verified(prefix, earliest, F.col("at2") < F.col("at"), sets, percent).select("a", "b").distinct(), "found")
    rest = _verified(prefix.join(found, ["a", "b"], "left_anti"), prefix, F.col("at2") <= F.col("at"), sets, percent)
    firsts = classes.select("a", "b", "first")
    sides = rest.join(firsts, ["a", "b"]).join(firsts.select(F.col("a").alias("a2"), F.col("b").alias("b2"), F.col("first").alias("first2")), ["a2", "b2"])
    later = staged(found.unionByName(sides.where(F.col("first2") < F.col("first")).select("a", "b").distinct()), "later")
    discard(written, prefix, found)
    return later


def removals(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc, doc_id, n_lines and removed (line numbers from 0, sorted) of every row of ``docs`` (doc_id, text).

    A line goes if an earlier line has a Jaccard similarity of at least ``percent`` on the sets of its runs of ``size``
    words; the earlier line may be one that goes too. Earlier is by doc_id (NULL last), then by a digest of the text
    where ids repeat, then by line. Words lie between blanks and keep their case. Lines with fewer words have no set:
    they are never removed and remove nothing. NULL counts as an empty text, which is one empty line. Rows that repeat both id and text
    are one document, and share their removals. Other columns are ignored.
    """
    lines = staged(_lines(docs, size, percent), "lines")
    rows = lines.where("line >= 0 AND n > 0").withColumn("unnamed", F.col("doc_id").isNull())
    place = F.struct(*PLACE)
    # Equal lines are one class before any token has a row of its own.
    classes = staged(rows.groupBy("a", "b").agg(F.min(place).alias("first"), F.max(place).alias("last"), F.first("n").alias("n"), F.first("head").alias("head")), "classes")
    later = later_classes(classes, docs, size, percent).withColumn("later", F.lit(True))
    # Classes that lose lines: those with several places, and those that come after a similar one.
    losing = classes.join(later, ["a", "b"], "left").where(F.col("later") | (F.col("first") < F.col("last"))).select("a", "b", "first", F.coalesce("later", F.lit(False)).alias("later"))
    losing = staged(losing, "losing")
    discard(classes)
    gone = rows.join(losing, ["a", "b"]).where(F.col("later") | (place > F.col("first")))
    removed = gone.groupBy("doc").agg(F.array_sort(F.collect_set("line")).alias("removed"))
    documents = lines.where("line < 0").select("doc", "doc_id", F.col("n").alias("n_lines"))
    return documents.join(removed, "doc", "left").withColumn("removed", F.coalesce("removed", F.array().cast("array<int>")))


def line_report(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_lines, n_removed and removed_sha256 (of the line numbers, comma-joined) of every row of ``docs`` (see :func:`removals`)."""
    numbers = F.array_join(F.col("removed").cast("array<string>"), ",")
    return removals(docs, size, percent).select("doc_id", F.col("n_lines").cast("long").alias("n_lines"), F.size("removed").cast("long").alias("n_removed"), F.sha2(numbers, 256).alias("removed_sha256"))


def remove_lines(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``docs``, all columns, with the text that remains (see :func:`removals`); an n_chars column follows the text.

    A NULL text stays NULL; a text that loses all of its lines becomes empty.
    """
    gone = removals(docs, size, percent).where(F.size("removed") > 0).select("doc", "removed").dropDuplicates(["doc"])
    doc = F.unhex(F.md5(F.concat_ws(" ", F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit("?")), F.coalesce("text", F.lit("")))))
    own = [c for c in docs.columns if c != "text"]
    joined = docs.select(F.struct(*docs.columns).alias("row"), doc.alias("doc")).join(gone, "doc", "left").select("row", "removed")
    left = F.when(F.col("removed").isNull(), F.col("row.text")).otherwise(
        F.array_join(F.expr("filter(split(row.text, '\n'), (l, i) -> NOT array_contains(removed, i))"), "\n"))
    out = joined.select(*(F.col(f"row.`{c}`").alias(c) for c in own), left.alias("text"))
    if "n_chars" in own:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


ORACLE = r"""
WITH l AS (SELECT doc_id, i - 1 AS line, len(all_lines) AS n_lines, regexp_extract_all(all_lines[i], '[^\x20\x09-\x0D]+') AS w
           FROM (SELECT doc_id, all_lines, unnest(range(1, len(all_lines) + 1)) AS i FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS all_lines FROM documents))),
t AS (SELECT doc_id, line, list_sort(list_distinct([array_to_string(w[p + 1 : p + 5], ' ') for p in range(0, len(w) - 4)])) AS s FROM l WHERE len(w) >= 5),
c AS (SELECT s, min((doc_id, line)) AS first, row_number() OVER () AS k FROM t GROUP BY s),
e AS (SELECT k, len(s) AS n, unnest(s) AS x FROM c),
m AS (SELECT p.k, q.k AS k2 FROM e p JOIN e q ON p.x = q.x AND p.k <> q.k AND p.n * 5 >= q.n * 4 AND q.n * 5 >= p.n * 4
      GROUP BY p.k, q.k, p.n, q.n HAVING 100 * count(*) >= 80 * (p.n + q.n - count(*))),
later AS (SELECT DISTINCT m.k FROM m JOIN c x ON x.k = m.k JOIN c y ON y.k = m.k2 WHERE y.first < x.first),
gone AS (SELECT t.doc_id, t.line FROM t JOIN c ON c.s = t.s LEFT JOIN later ON later.k = c.k WHERE later.k IS NOT NULL OR (t.doc_id, t.line) > c.first),
g AS (SELECT doc_id, count(*) AS n_removed, string_agg(line::VARCHAR, ',' ORDER BY line) AS numbers FROM gone GROUP BY doc_id)
SELECT d.doc_id, d.n_lines, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(numbers, '')) AS removed_sha256
FROM (SELECT DISTINCT doc_id, n_lines FROM l) d LEFT JOIN g USING (doc_id)
"""
