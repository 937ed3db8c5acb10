"""Benchmark decontamination as a prefix-filtered containment join.

An item is cut into windows of consecutive words, and a window into shingles. To be contained whole, a window needs
each of its shingles, so one suffices as its prefix: the one rarest in the corpus. Document shingles
that no item has never leave their task. Those left give the counts that order by rarity, the prefix matches,
and the verification: a match says where the window would start, which bounds it by the text's length,
and all its words must be there in place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.session import staged

WINDOW = 10  # words
SHINGLE = 3  # words

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Words are what lies between ASCII characters that are neither digits nor lower-case letters.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Words with A-Z lower-cased; none for NULL."""
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), F.lit(WORD), F.lit(0))


def _name() -> Column:
    """A digest of doc_id and text."""
    return F.unhex(F.md5(F.concat_ws(" ", F.coalesce(F.col("doc_id").cast("string"), F.lit("?")), F.coalesce("text", F.lit("")))))


def _heads(size: int) -> str:
    """SQL of the digests of all shingles of ``size`` in ``words``."""
    run = ", ".join(f"words[i + {k}]" for k in range(size))
    return f"CASE WHEN size(words) >= {size} THEN transform(sequence(0, size(words) - {size}), i -> xxhash64({run})) ELSE array() END"


def item_windows(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """item_id, words, text and size of each window of each item; an item of fewer words is one window."""
    cut = items.select(F.col("item_id").cast("string").alias("item_id"), words(F.col("text")).alias("all")).where(F.size("all") > 0)
    starts = F.explode(F.expr(f"sequence(0, greatest(size(all) - {window}, 0))")).alias("start")
    return cut.select("item_id", "all", starts).select("item_id", F.expr(f"slice(all, start + 1, {window})").alias("words")).select(
        "item_id", "words", F.array_join("words", " ").alias("window"), F.size("words").alias("length"))


def corpus_shingles(docs: DataFrame, tokens: DataFrame, sizes: list[int]) -> DataFrame:
    """doc, doc_id, n_words, size, position and head of document shingles that are among ``tokens`` (size, head).

    Each document also has one row of size 0, which stands for itself. ``doc`` is a digest of doc_id and text.
    """
    cut = docs.select("doc_id", _name().alias("doc"), words(F.col("text")).alias("words"))
    parts = [f"transform({_heads(s)}, (h, p) -> named_struct('size', {s}, 'position', p, 'head', h))" for s in sizes]
    itself = "array(named_struct('size', 0, 'position', 0, 'head', 0L))"
    # The outer form: for the inner one Spark infers a filter on the array, which would cut the words again for each of them.
    rows = cut.select("doc_id", "doc", F.expr("size(words)").alias("n_words"), F.explode_outer(F.expr(f"concat({', '.join([itself, *parts])})")).alias("s"))
    spread = rows.select("doc_id", "doc", "n_words", "s.size", "s.position", "s.head")
    return spread.join(tokens.union(tokens.sparkSession.sql("SELECT 0 AS size, 0L AS head")), ["size", "head"])


def occurrences(docs: DataFrame, items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Documents (doc, doc_id, n_words; repeated rows repeat), verified occurrences (doc, start, length, window) and the windows of items."""
    spark = docs.sparkSession
    found = staged(item_windows(items, window), "windows")
    sizes = sorted({min(shingle, r["length"]) for r in found.select("length").distinct().collect()})  # at most ``window`` lengths
    size = F.least("length", F.lit(shingle))
    heads = F.coalesce(*[F.when(size == s, F.expr(_heads(s))) for s in sizes]) if sizes else F.array().cast("array<bigint>")
    windows = staged(found.select("window", "length", "words").distinct().select("window", "length", size.alias("size"), heads.alias("heads")), "window-shingles")
    tokens = windows.select("size", F.explode("heads").alias("head")).distinct()
    # As a table its size is known, so Spark broadcasts it if it is small and sorts both sides if not.
    hits = staged(corpus_shingles(docs, staged(tokens, "tokens"), sizes), "hits")
    documents = hits.where("size = 0").select("doc", "doc_id", "n_words")
    shingles = hits.where("size > 0")
    rarity = shingles.groupBy("size", "head").count()
    each = windows.select("window", "length", "size", "heads", F.posexplode("heads").alias("offset", "head"))
    ranked = each.join(rarity, ["size", "head"], "left").withColumn("count", F.coalesce("count", F.lit(0)))
    prefix = ranked.groupBy("window", "length", "size", "heads").agg(F.min(F.struct("count", "offset", "head")).alias("rarest")).where("rarest.count > 0").select(
        "window", "length", "size", "heads", F.col("rarest.offset").alias("offset"), F.col("rarest.head").alias("head"))
    start = F.col("position") - F.col("offset")
    candidates = shingles.join(staged(prefix, "prefixes"), ["size", "head"]).where((start >= 0) & (start + F.col("length") <= F.col("n_words"))).select(
        "doc", start.alias("start"), "window", "length", "size", "heads")
    # shingles side by side, and the last one, hold every word of the window
    places = F.expr("array_distinct(concat(sequence(0, size(heads) - 1, size), array(size(heads) - 1)))")
    wanted = candidates.select("doc", "start", "window", "length", "size", "heads", F.size(places).alias("needed"), F.posexplode(places).alias("part", "place")).select(
        "doc", "start", "window", "length", "size", "needed", "part", (F.col("start") + F.col("place")).alias("position"), F.expr("heads[place]").alias("head"))
    there = wanted.join(shingles.select("doc", "size", "position", "head"), ["doc", "size", "position", "head"])
    verified = there.groupBy("doc", "start", "window", "length", "needed").agg(F.bit_or(F.expr("shiftleft(1L, part)")).alias("seen")).where(
        F.expr("seen = shiftleft(1L, needed) - 1")).select("doc", "start", "length", "window")
    return documents, staged(verified, "occurrences"), found.select("item_id", "window").distinct()


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256 and contaminated of every row of ``docs`` (doc_id, text).

    ``items`` has item_id and text. A word is hit if it lies in an occurrence of a window of any item; items without
    words, and NULL texts on either side, match nothing. ``items_sha256`` digests the ids of items with an occurrence,
    sorted as strings; an item without id is not listed. Repeated rows, also of items, give the same
    answer as one. Other columns are ignored. An empty ``items`` leaves all documents clean.
    """
    documents, verified, owners = occurrences(docs, items, window, shingle)
    before = Window.partitionBy("doc").orderBy("start", "stop").rowsBetween(Window.unboundedPreceding, -1)
    spans = verified.select("doc", "start", (F.col("start") + F.col("length")).alias("stop")).distinct()
    fresh = F.greatest(F.col("stop") - F.greatest(F.col("start"), F.coalesce(F.max("stop").over(before), F.lit(0))), F.lit(0))
    hit = spans.withColumn("fresh", fresh).groupBy("doc").agg(F.sum("fresh").cast("long").alias("n_hit"))
    listed = verified.select("doc", "window").distinct().join(owners, "window").groupBy("doc").agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    items_ = F.coalesce("items", F.array().cast("array<string>"))
    return documents.join(hit.join(listed, "doc", "left"), "doc", "left").select(
        "doc_id", F.col("n_words").cast("long").alias("n_words"), F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.size(items_).cast("long").alias("n_items"),
        F.sha2(F.array_join(items_, ","), 256).alias("items_sha256"), (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"))


def keep_clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, without an occurrence of a window of any item (see :func:`contamination`)."""
    _, verified, _ = occurrences(docs, items)
    hit = staged(verified.select("doc").distinct(), "contaminated")
    rows = docs.select(F.struct(*docs.columns).alias("row"), _name().alias("doc"))
    return rows.join(hit, "doc", "left_anti").select(*(F.col(f"row.`{c}`").alias(c) for c in docs.columns))


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id,
                  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id::VARCHAR AS item_id,
             regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, w[s + 1 : s + 10] AS win, least(len(w), 10) AS n
       FROM (SELECT *, unnest(range(0, greatest(len(w) - 10, 0) + 1)) AS s FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT r, s, n, w[s + 1 : s + n] AS win
       FROM (SELECT r, w, n, unnest(range(0, len(w) - n + 1)) AS s FROM d, sizes WHERE len(w) >= n)),
o AS (SELECT r, s, dw.n, item_id FROM dw JOIN bw ON dw.win = bw.win AND dw.n = bw.n),
h AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(s, s + n)) AS p FROM o) GROUP BY r),
i AS (SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT r, item_id FROM o) GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (r) LEFT JOIN i USING (r)
"""
