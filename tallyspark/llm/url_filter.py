"""Verdicts on urls: fixed rules first, then the reputation that labelled pages give a host.

The share of bad pages of a host is given a beta prior, whose mean is the share of its registered domain
and whose weight is estimated from how much hosts differ inside domains; domains get theirs from suffixes,
suffixes from all pages. What a level hands down leaves out the pages of the one it is handed to, so that no
page counts twice. A host is blocked if the lower bound of its posterior share is above a limit, so few or
no labelled pages never block a host by themselves.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.session import staged

# A host whose share of bad pages is above LIMIT with this probability is blocked.
LIMIT, CONFIDENCE = 0.5, 0.95
# Bounds of the weight of a prior, in pages, and the weight where no group has two labelled pages.
LEAST, MOST, UNKNOWN = 2.0, 10_000.0, 10.0
# A key with more than this share of all rows is joined by broadcast; there are at most 64.
HOT = 64
# Labels that make a suffix together with a country's.
SECOND_LEVEL = ("ac", "co", "com", "edu", "gov", "net", "org")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.coalesce(F.translate(F.regexp_extract(url, "://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty if there is no ``://``."""
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def with_levels(hosts: DataFrame) -> DataFrame:
    """``hosts`` with the columns domain and suffix. An address made of numbers is its own domain and suffix."""
    bare = F.regexp_replace("host", r"^.*@|:[0-9]*$|\.+$", "")
    labels = F.split(F.col("_bare"), r"\.")
    two = F.col("_labels")[F.size("_labels") - 2].isin(*SECOND_LEVEL) & (F.length(F.element_at("_labels", -1)) == 2)
    long = F.when((F.size("_labels") > 2) & two, 2).otherwise(1)
    whole = F.col("_bare").rlike(r"^[0-9.]*$|^\[")

    def last(n: str) -> Column:
        return F.when(whole | (F.size("_labels") <= F.expr(n)), F.col("_bare")).otherwise(F.expr(f"array_join(slice(_labels, -({n}), {n}), '.')"))

    known = hosts.withColumn("_bare", bare).withColumn("_labels", labels).withColumn("_long", long)
    return known.withColumns({"domain": last("_long + 1"), "suffix": last("_long")}).drop("_bare", "_labels", "_long")


def parse_rules(rules: Sequence[tuple[str, str]]) -> list[tuple[str, str, str, str]]:
    """(verdict, rule) such as ("block", "example.com/de/") as verdict, rule, host and path, longest first, then block."""
    out = []
    for verdict, rule in rules:
        name, slash, rest = rule.partition("/")
        if not name or verdict not in ("allow", "block"):
            raise ValueError(f"not a rule: {verdict} {rule}")
        out.append((verdict, rule, name, slash + rest))
    return sorted(out, key=lambda r: (-len(r[1]), r[0] != "block", r[1]))


def _first_fit(rules: list[tuple[str, str, str, str]], value: int) -> Column:
    """Entry ``value`` of the first rule that fits host and path, else NULL."""
    found = F.lit(None).cast("string")
    for rule in reversed(rules):
        on_host = (F.col("host") == rule[2]) | F.col("host").endswith("." + rule[2])
        found = F.when(on_host & F.col("path").startswith(rule[3]), F.lit(rule[value])).otherwise(found)
    return found


def _upper_tail(x: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Probability that a beta variable with parameters ``a`` and ``b`` is above ``x``, by its continued fraction."""
    turn = x > (a + 1) / (a + b + 2)
    x, a, b = np.where(turn, 1 - x, x), np.where(turn, b, a), np.where(turn, a, b)
    gamma = np.frompyfunc(math.lgamma, 1, 1)
    front = (gamma(a + b) - gamma(a) - gamma(b)).astype(float) + a * np.log(x) + b * np.log1p(-x)
    tiny = 1e-300
    c, d = np.ones_like(x), 1 - (a + b) * x / (a + 1)
    d = 1 / np.where(np.abs(d) < tiny, tiny, d)
    value = d.copy()
    for m in range(1, 2000):
        change = np.ones_like(x)
        for factor in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
                       -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1 + factor * d
            d = 1 / np.where(np.abs(d) < tiny, tiny, d)
            c = 1 + factor / c
            c = np.where(np.abs(c) < tiny, tiny, c)
            change = c * d
            value *= change
        if np.all(np.abs(change - 1) < 1e-13):
            break
    below = np.exp(front) / a * value
    return np.where(turn, below, 1 - below)


def _lower_bound(a: np.ndarray, b: np.ndarray, confidence: float) -> np.ndarray:
    """The value that the beta variable is above with probability ``confidence``, halving the interval."""
    low, high = np.zeros_like(a), np.ones_like(a)
    for _ in range(40):
        middle = (low + high) / 2
        above = _upper_tail(middle, a, b) >= confidence
        low, high = np.where(above, middle, low), np.where(above, high, middle)
    return low


def lower_bound(a: Column, b: Column, confidence: float = CONFIDENCE) -> Column:
    @F.pandas_udf("double")
    def bound(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series(_lower_bound(x.to_numpy(float), y.to_numpy(float), confidence))

    return bound(a, b)


def _join_counted(left: DataFrame, right: DataFrame, key: str, rows: str) -> DataFrame:
    """Inner join with ``right``, which has each key once and in ``rows`` how many rows of ``left`` have it.

    Keys with more than a ``HOT``-th of all rows, so fewer than ``HOT`` of them, are broadcast and their rows stay
    where they are; only the others are shuffled.
    """
    total = right.agg(F.sum(rows)).first()[0] or 0
    hot = right.filter(F.col(rows) * HOT > total)
    cold = left.join(F.broadcast(hot.select(key)), key, "left_anti")
    return left.join(F.broadcast(hot), key).unionByName(cold.join(right.filter(F.col(rows) * HOT <= total), key))


def _weight(groups: DataFrame) -> float:
    """Weight of the prior, from the spread of ``bad`` of ``n`` around ``n * prior`` beyond chance."""
    chance = F.col("prior") * (1 - F.col("prior"))
    spread, scale = groups.agg(
        F.sum((F.col("bad") - F.col("n") * F.col("prior")) ** 2 - F.col("n") * chance),
        F.sum(F.col("n") * (F.col("n") - 1) * chance)).first()
    if not scale:
        return UNKNOWN
    share = min(max(spread / scale, 1 / (1 + MOST)), 1 / (1 + LEAST))
    return round(1 / share - 1, 6)


def reputation(hosts: DataFrame, confidence: float = CONFIDENCE) -> DataFrame:
    """host, pages, n, bad, prior, weight and ``bad_lower`` of ``hosts`` (host, pages, n labelled, bad among these).

    ``hosts`` has each host once, also those without labelled pages, which have the posterior that their domain gives
    them. Without any labelled page every prior is a half and the weight ``UNKNOWN``.
    """
    hosts = staged(with_levels(hosts.select("host", "pages", "n", "bad")), "hosts")
    sums = [F.sum(c).alias(c) for c in ("n", "bad")]
    domains = staged(hosts.groupBy("domain").agg(*sums, F.max("suffix").alias("suffix"), F.count(F.lit(1)).alias("members")), "domains")
    suffixes = staged(domains.groupBy("suffix").agg(*sums, F.count(F.lit(1)).alias("members")), "suffixes")
    total = suffixes.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n", "bad")]).first()

    # The mean of the level above, without this group's own pages, is its prior.
    suffixes = suffixes.withColumn("prior", (total["bad"] - F.col("bad") + 0.5) / (total["n"] - F.col("n") + 1))
    domains = _with_prior(domains, suffixes, "suffix")
    hosts = _with_prior(hosts, domains, "domain")
    weight = F.lit(_weight(hosts))
    bound = lower_bound(weight * F.col("prior") + F.col("bad"), weight * (1 - F.col("prior")) + F.col("n") - F.col("bad"), confidence)
    return hosts.select("host", "domain", "suffix", "pages", "n", "bad", "prior", weight.alias("weight"), bound.alias("bad_lower"))


def _with_prior(groups: DataFrame, above: DataFrame, key: str) -> DataFrame:
    """``groups`` with the posterior mean of their group ``above``, from its other members' pages alone, as prior."""
    weight = _weight(above)
    up = above.select(key, F.col("members").alias("up_members"), F.col("n").alias("up_n"), F.col("bad").alias("up_bad"), F.col("prior").alias("up_prior"))
    prior = (weight * F.col("up_prior") + F.col("up_bad") - F.col("bad")) / (weight + F.col("up_n") - F.col("n"))
    joined = _join_counted(groups, up, key, "up_members").withColumn("prior", prior)
    return staged(joined.select(*groups.columns, "prior"), f"{key}-priors")


def judge(pages: DataFrame, outcomes: DataFrame, rules: Sequence[tuple[str, str]] = (), limit: float = LIMIT,
          confidence: float = CONFIDENCE) -> DataFrame:
    """page_id, host, path, rule, verdict, and n_labelled, n_bad and bad_lower of the host, for every row of ``pages``.

    ``pages`` has page_id and url, ``outcomes`` host, n labelled pages and bad ones among them; hosts may repeat and
    need not occur in ``pages``. The longest rule that fits decides, of two equally long ones that which blocks; a rule
    fits its host and all subdomains if the path starts with the rule's. Elsewhere the verdict is "block" where
    ``bad_lower`` is above ``limit``, else "allow". A NULL url and one without ``://`` have an empty host and path, and
    all of them are one host. Rows are kept as they are, also repeated ones and those with a NULL page_id; an empty
    table gives none, other columns are ignored. Urls of any length are read whole. A host may hold any share of
    the rows: it is counted before the shuffle and its rows stay in place afterwards.
    """
    urls = pages.select("page_id", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))
    seen = urls.groupBy("host").agg(F.count(F.lit(1)).alias("pages")).select("host", "pages", F.lit(0).alias("n"), F.lit(0).alias("bad"))
    known = outcomes.select("host", F.lit(0).alias("pages"), "n", "bad").filter(F.col("host").isNotNull())
    counted = seen.unionByName(known).groupBy("host").agg(*[F.sum(c).cast("long").alias(c) for c in ("pages", "n", "bad")])
    hosts = staged(reputation(counted, confidence), "reputation").filter("pages > 0")
    found = parse_rules(rules)
    by_method = F.when(F.col("bad_lower") > limit, "block").otherwise("allow")
    return _join_counted(urls, hosts, "host", "pages").select(
        "page_id", "host", "path", _first_fit(found, 1).alias("rule"), F.coalesce(_first_fit(found, 0), by_method).alias("verdict"),
        F.col("n").alias("n_labelled"), F.col("bad").alias("n_bad"), "bad_lower")


def outcomes_of(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """host, n and bad, from labels of the documents that pages were made from.

    The number at the end of a page's path, as in ``/en/825`` or ``/en/825.html``, is the document's. A page is bad if a
    label of the document says toxic = 1 or quality = 0; documents without a label, or with NULLs only, give no outcome.
    Labels that repeat count once, pages that repeat as often as they do.
    """
    number = F.regexp_extract(path(F.col("url")), r"/([0-9]{1,18})(\.html)?/?$", 1).try_cast("long")
    numbered = pages.select(host(F.col("url")).alias("host"), number.alias("doc_id"))
    counted = numbered.filter("doc_id IS NOT NULL").groupBy("doc_id", "host").agg(F.count(F.lit(1)).alias("n"))
    bad = F.when((F.col("toxic") == 1) | (F.col("quality") == 0), 1).when(F.coalesce("toxic", "quality").isNotNull(), 0)
    judged = labels.select(F.col("doc_id").cast("long").alias("doc_id"), bad.alias("bad")).filter("doc_id IS NOT NULL AND bad IS NOT NULL")
    judged = judged.groupBy("doc_id").agg(F.max("bad").alias("bad"))
    return counted.join(judged, "doc_id").groupBy("host").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("bad")).alias("bad"))
