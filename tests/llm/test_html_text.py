"""Main text of pages: structure, references, broken markup, and what a host repeats."""

import pytest

from tallyspark.llm import html_text

ARTICLE = ("<html><head><title>x</title><style>p{}</style><script>var t='</p>';</script></head><body><nav><a>menu</a></nav><header>top</header>"
           "<article><h1>A &amp; B</h1><p><b>one\n two<br><p>three&nbsp;&#8364;</p><aside>no</aside><div class='comments'>no<p>no</div><form>no</form>last &am</article>"
           "<div class=ad>no</div><footer>no</footer>")
SCHEMA = "page_id long, url string, html string, text string"


def texts(spark, rows):
    return {r.page_id: (r.text, r.n_chars) for r in html_text.extract(spark.createDataFrame(rows, SCHEMA)).collect()}


def test_structure(spark):
    out = texts(spark, [(1, "http://a/x", ARTICLE, "t"), (2, None, None, None), (3, "http://a/y", "", None), (4, "u", "plain <b", None)])
    want = "A & B\none two\nthree €\nlast &am"
    assert out == {1: (want, len(want)), 2: ("", 0), 3: ("", 0), 4: ("plain", 5)}


def test_host_repeats(spark):
    same = "<div>All rights are reserved by the owner of this site</div>"
    rows = [(i, f"https://Host.example/{i}", f"<body>{same}<div>text number {i} is about topic{i} and its{i} own{i} words{i}</div>{same}", None) for i in range(6)]
    rows += [(10, "https://other.example/1", f"<body>{same}<p>own", None)]
    out = texts(spark, rows)
    for i in range(6):
        assert out[i][0] == f"text number {i} is about topic{i} and its{i} own{i} words{i}"
    assert out[10][0] == "All rights are reserved by the owner of this site\nown"


def test_runs_equal_brute_force(spark):
    import random

    rnd = random.Random(1)
    pages = [(i, "https://h/", [" ".join(rnd.choice("abcde") for _ in range(rnd.randint(1, 30))) for _ in range(3)]) for i in range(25)]
    found = spark.createDataFrame([(i, u, i, "h", [1, 0, 1], t) for i, u, t in pages], "page_id long, url string, page long, host string, roles array<int>, texts array<string>")
    order = html_text.suffixes(found)
    got = {(r.page, r.block): r.covered for r in html_text.covered(order, html_text.repeated(order)).collect()}

    def heads(t):
        w = t.split(" ")
        return [(k, tuple(w[k : k + 5])) for k in range(max(1, len(w) - 4))]

    owners = {}
    for i, _, ts in pages:
        for t in ts:
            for _, h in heads(t):
                owners.setdefault(h, set()).add(i)
    want = {}
    for i, _, ts in pages:
        for b, t in enumerate(ts):
            if b == 1:  # chrome takes part, but is not judged
                continue
            tokens = {x for k, h in heads(t) if len(owners[h]) > 1 for x in range(k, k + len(h))}
            if tokens:
                want[i, b] = len(tokens)
    assert got == want


@pytest.mark.parametrize("rows", [[], [(None, None, None, None), (1, "http://a/", "<article>x", "y"), (1, "http://a/", "<article>x", "y")]])
def test_empty_and_repeated(spark, rows):
    out = html_text.extract(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(r.text for r in out) == sorted("x" if r[0] else "" for r in rows)


def test_copies_and_phrases_of_few_pages_stay(spark):
    """An article under two addresses and in a print version, a phrase on two pages of many, and an article in an element named as chrome."""
    story = "<p>the mayor opened a new bridge across the river on monday and many people came to see it</p>"
    foot = "<div>All rights are reserved by the owner of this site</div>"
    rows = [(1, "http://h/a", story + foot, None), (2, "http://h/b", story + foot, None), (3, "http://h/print", story, None)]
    rows += [(i, f"http://h/{i}", f"<p>at the end of the day page{i} was alone{i}</p>{foot}", None) for i in range(10, 12)]
    rows += [(i, f"http://h/{i}", f"<p>only{i} words{i} of{i} its{i} own{i} here{i}</p>{foot}", None) for i in range(12, 20)]
    rows += [(30, "http://k/", "<div class='page-with-sidebar'>no<article>real text<div id='share'>no</div></article></div>", None)]
    out = {i: t for i, (t, _) in texts(spark, rows).items()}
    assert out[1] == out[2] == out[3] == "the mayor opened a new bridge across the river on monday and many people came to see it"
    assert out[10] == "at the end of the day page10 was alone10" and out[15] == "only15 words15 of15 its15 own15 here15"
    assert out[30] == "real text"


def random_pages(seed, number):
    import random

    rnd = random.Random(seed)
    return [([rnd.choice([0, 1, 1, 2, 2, 2, 2, 2, 2, 2, 2]) for _ in range(9)], [" ".join(rnd.choice("ab") for _ in range(rnd.randint(1, 30))) for _ in range(9)]) for _ in range(number)]


def plain_runs(pages, least, run):
    """Runs of tokens, as text, with the pages that have them, and those that have them at an end of the article."""
    every, edges = {}, {}
    for n, (roles, texts) in enumerate(pages):
        article = [k for k, r in enumerate(roles) if r == html_text.KEEP]
        for k, t in enumerate(texts):
            w = t.lower().split(" ")
            for i in range(max(1, len(w) - run + 1)):
                every.setdefault(tuple(w[i : i + run]), set()).add(n)
                if k in article[: html_text.EDGE] + article[-html_text.EDGE :]:
                    edges.setdefault(tuple(w[i : i + run]), set()).add(n)
    return sorted((len(p), len(edges.get(r, ()))) for r, p in every.items() if len(p) >= least)


def test_suffix_array_is_sorted_and_its_repeats_equal_a_plain_count():
    import numpy as np

    for seed in range(5):
        pages = random_pages(seed, 12)
        s = html_text.Streams(pages, 6)
        order = html_text.suffix_array(s.codes, s.ends)
        suffixes = [tuple(s.codes[i : s.ends[i]]) for i in order]
        assert suffixes == sorted(suffixes) and sorted(order) == list(range(len(s.codes)))
        shared = [next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b))) for a, b in zip(suffixes, suffixes[1:], strict=False)]
        assert np.array_equal(html_text.common_prefixes(order, s.codes, s.ends, 99), shared)
        got = html_text.repeats(pages, 3, 6)
        assert sorted((n, e) for _, n, e, _ in got) == plain_runs(pages, 3, 6)
        assert len({d for d, *_ in got}) == len(got)
    assert html_text.repeats([([], [])], 1) == []


@pytest.mark.parametrize("piece", [1 << 20, 700])
def test_boilerplate_in_articles_goes_and_unique_text_stays(spark, piece):
    """Also if the host's pages are dealt into several pieces; a sentence amid articles and articles that are mostly the same stay."""
    share = "<p>Share this story with all of your friends on every network today</p>"
    said = "<p>the same saying stands in the middle of each of these many articles</p>"

    def own(i, n):
        return "".join(f"<p>{' '.join(f'w{i}x{n}y{k}' for k in range(12))} part {k}</p>" for k in range(n))

    rows = [(i, f"http://h/{i}", f"<nav>a b</nav><article>{own(i, 4)}{said}{own(i + 100, 4)}{share}</article>", None) for i in range(12)]
    same = "".join(f"<p>all pages of this host say exactly this in line {k} of theirs</p>" for k in range(4))
    rows += [(i, f"http://copies/{i}", f"<article>{same}<p>number{i}</p></article>", None) for i in range(20, 30)]
    frame = spark.createDataFrame(rows, SCHEMA)
    out = {r.page_id: r.text for r in html_text.extract(frame, piece=piece).collect()}
    for i in range(12):
        assert "Share this" not in out[i] and out[i].count("\n") == 8 and "the same saying" in out[i]
    assert all(out[i].count("\n") == 4 for i in range(20, 30))


def test_pieces_of_a_host_give_the_runs_of_the_whole(spark):
    """The runs of a host, whatever the size of its pieces."""
    rows = []
    for n, (roles, texts) in enumerate(random_pages(7, 40)):
        rows.append((n, "u", "h", 400, n % 37, [max(r, 0) for r in roles], texts))
    rows = [(*r[:4], r[4], *rows[r[4]][5:]) for r in rows]  # equal copies have equal blocks
    found = spark.createDataFrame(rows, "page_id long, url string, host string, length long, copy long, roles array<int>, texts array<string>")

    def runs(piece):
        return [(r.host, sorted(r.inner), sorted(r.edges)) for r in html_text.boilerplate(found, 5, 0.4, piece).collect()]


    whole = runs(1 << 30)
    assert whole and whole[0][1] and whole == runs(3000) == runs(1500)
