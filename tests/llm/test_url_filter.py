"""Rules and parts of urls against plain Python, posteriors against sums over a fine grid."""

import math
import re

import numpy as np
import pytest

from tallyspark.llm import url_filter as uf
from tallyspark.llm.queries import QUERIES, URL_RULES, table

SF = "/root/testdata/sf0.01"


def parts(url):
    """Host and path, character by character."""
    if url is None or "://" not in url:
        return "", ""
    rest = url[url.index("://") + 3 :]
    end = next((i for i, c in enumerate(rest) if c in "/?#"), len(rest))
    tail = rest[end:]
    stop = next((i for i, c in enumerate(tail) if c in "?#"), len(tail))
    return "".join(c.lower() if c.isascii() else c for c in rest[:end]), tail[:stop]


def rule_of(host, path, rules=URL_RULES):
    fits = []
    for verdict, rule in rules:
        name, rest = rule[: rule.index("/")], rule[rule.index("/") :]
        if (host == name or host.endswith("." + name)) and path.startswith(rest):
            fits.append((-len(rule), verdict != "block", rule, verdict))
    return min(fits)[2:] if fits else (None, None)


def posterior_bound(a, b, confidence):
    """Lower bound by summing the density on a grid in the logit."""
    z = np.linspace(-2500, 2500, 2_500_001)
    log_x, log_rest = -np.logaddexp(0, -z), -np.logaddexp(0, z)
    density = np.exp(a * log_x + b * log_rest + math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b))
    below = np.cumsum(density) / density.sum()
    return float(np.exp(log_x[np.searchsorted(below, 1 - confidence)]))


def levels(host):
    bare = re.sub(r"^.*@|:[0-9]*$|\.+$", "", host)
    labels = bare.split(".")
    if re.match(r"^[0-9.]*$|^\[", bare):
        return bare, bare
    k = 2 if len(labels) > 2 and labels[-2] in uf.SECOND_LEVEL and len(labels[-1]) == 2 else 1
    return ".".join(labels[-k - 1 :]), ".".join(labels[-k:])


def brute_reputation(hosts):
    """hosts: {host: (n, bad)}; each level in plain loops. host -> (prior, weight, bound)."""
    def weight(groups):
        scale = sum(n * (n - 1) * p * (1 - p) for n, _, p in groups)
        if not scale:
            return uf.UNKNOWN
        share = sum((bad - n * p) ** 2 - n * p * (1 - p) for n, bad, p in groups) / scale
        return round(1 / min(max(share, 1 / (1 + uf.MOST)), 1 / (1 + uf.LEAST)) - 1, 6)

    def sums(key):
        out = {}
        for h, (n, bad) in hosts.items():
            a, b = out.get(key(h), (0, 0))
            out[key(h)] = (a + n, b + bad)
        return out

    n_all, bad_all = (sum(v[i] for v in hosts.values()) for i in (0, 1))
    suffixes, domains = sums(lambda h: levels(h)[1]), sums(lambda h: levels(h)[0])
    above = {levels(h)[0]: levels(h)[1] for h in hosts}
    p_suffix = {s: (bad_all - bad + 0.5) / (n_all - n + 1) for s, (n, bad) in suffixes.items()}
    w = weight([(*suffixes[s], p) for s, p in p_suffix.items()])
    p_domain = {d: (w * p_suffix[above[d]] + suffixes[above[d]][1] - bad) / (w + suffixes[above[d]][0] - n) for d, (n, bad) in domains.items()}
    w = weight([(*domains[d], p) for d, p in p_domain.items()])
    p_host = {}
    for h, (n, bad) in hosts.items():
        d = levels(h)[0]
        p_host[h] = (w * p_domain[d] + domains[d][1] - bad) / (w + domains[d][0] - n)
    w = weight([(*hosts[h], p) for h, p in p_host.items()])
    return {h: (p, w, posterior_bound(w * p + hosts[h][1], w * (1 - p) + hosts[h][0] - hosts[h][1], uf.CONFIDENCE)) for h, p in p_host.items()}


HOSTS = {"a.bad.com": (40, 39), "b.bad.com": (30, 30), "new.bad.com": (0, 0), "good.com": (200, 3), "one.good.com": (1, 1), "c.org": (50, 4),
         "x.co.uk": (20, 19), "y.x.co.uk": (0, 0), "z.co.uk": (9, 0), "10.0.0.1": (3, 3), "user@c.org:80": (2, 0), "": (4, 1), "com": (0, 0)}


def test_reputation_equals_brute_force(spark):
    hosts = spark.createDataFrame([(h, 5, n, bad) for h, (n, bad) in HOSTS.items()], "host string, pages long, n long, bad long")
    want = brute_reputation(HOSTS)
    rows = uf.reputation(hosts).collect()
    assert len(rows) == len(HOSTS)
    for r in rows:
        prior, weight, bound = want[r.host]
        assert (r.domain, r.suffix) == levels(r.host)
        assert r.prior == pytest.approx(prior) and r.weight == pytest.approx(weight, abs=1e-5)
        assert r.bad_lower == pytest.approx(bound, abs=2e-3)
    bounds = {r.host: r.bad_lower for r in rows}
    assert min(bounds["a.bad.com"], bounds["b.bad.com"]) > 0.5 > max(bounds["good.com"], bounds["one.good.com"], bounds["c.org"])


def test_one_bad_page_does_not_block(spark):
    rows = [(f"h{i}.example.com", 30, i % 3) for i in range(20)] + [("single.example.com", 1, 1), ("spam.example.com", 60, 58)]
    outcomes = spark.createDataFrame(rows, "host string, n long, bad long")
    pages = spark.createDataFrame([(i, f"http://{h}/p") for i, (h, *_) in enumerate(rows)] + [(99, "http://unseen.example.com/p")], "page_id long, url string")
    got = {r.host: r.verdict for r in uf.judge(pages, outcomes).collect()}
    assert {h for h, v in got.items() if v == "block"} == {"spam.example.com"}


URLS = [None, "", "no scheme", "://", "http://NET/", "http://net", "http://net?x/", "https://A.Example.NET/en/1?x#y", "https://example.net/en", "x://bexample.net/en/",
        "http://example.com/de/5#t", "http://sub.example.com/de/?q", "http://fr.org/fr/://x/", "http://org/fr/", "http://ÄB.org/fr/9", "a://b.com/c://net/", "http://h.com:80/x",
        "http://example.net./en/", "http://" + "w" * 100_000 + ".net/" + "p" * 100_000]


def test_parts_and_rules(spark):
    pages = spark.createDataFrame([(i, u, "h", 1) for i, u in enumerate(URLS)] + [(None, URLS[7], "h", 1)] * 2, "page_id long, url string, host string, n int")
    nothing = spark.createDataFrame([], "host string, n long, bad long")
    got = uf.judge(pages, nothing, URL_RULES).collect()
    assert len(got) == len(URLS) + 2
    for r in got:
        host, path = parts(URLS[7 if r.page_id is None else r.page_id])
        rule, verdict = rule_of(host, path)
        assert (r.host, r.path, r.rule, r.verdict) == (host, path, rule, verdict or "allow")
    assert uf.judge(pages.limit(0), nothing, URL_RULES).collect() == []
    with pytest.raises(ValueError):
        uf.judge(pages, nothing, [("block", "/x")])


def test_outcomes(spark):
    pages = spark.createDataFrame([(1, "http://a.com/en/7.html"), (2, "http://a.com/en/7?x"), (3, "http://a.com/8/"), (4, "http://b.com/en/8"), (5, "http://b.com/x9"),
                                   (6, None), (7, "http://b.com/en/10"), (8, "http://b.com/" + "1" * 30), (9, "http://b.com/11")], "page_id long, url string")
    labels = spark.createDataFrame([(7, 1, 0), (7, 1, 1), (8, 1, 0), (10, None, None), (None, 0, 1), (11, 0, None)], "doc_id long, quality int, toxic int")
    assert sorted(map(tuple, uf.outcomes_of(pages, labels).collect())) == [("a.com", 3, 2), ("b.com", 2, 1)]


def test_query_equals_brute_force(spark):
    pages, labels = table(spark, SF, "pages").collect(), {}
    for r in table(spark, SF, "labels").collect():
        labels[r.doc_id] = max(labels.get(r.doc_id, 0), int(r.toxic == 1 or r.quality == 0))
    hosts = {parts(p.url)[0]: (0, 0) for p in pages}
    for p in pages:
        host, path = parts(p.url)
        number = re.search(r"/([0-9]{1,18})(\.html)?/?$", path)
        if number and int(number[1]) in labels:
            hosts[host] = (hosts[host][0] + 1, hosts[host][1] + labels[int(number[1])])
    want = brute_reputation(hosts)
    rows = {r.page_id: r for r in QUERIES["op13_url_filter"](spark, SF).collect()}
    assert len(rows) == len(pages) and sum(n for n, _ in hosts.values()) > 50
    for p in pages:
        r, (host, path) = rows[p.page_id], parts(p.url)
        rule, verdict = rule_of(host, path)
        bound = want[host][2]
        assert (r.host, r.path, r.rule, r.n_labelled, r.n_bad) == (host, path, rule, *hosts[host])
        assert r.bad_lower == pytest.approx(bound, abs=2e-3)
        assert r.verdict == (verdict or ("block" if bound > uf.LIMIT else "allow"))
