"""Surrogates: what is found, what is kept, and that they are distinct and consistent."""

import re

import pytest

from tallyspark.llm import surrogates as S

TEXTS = [
    "Mail Anna.Lee@mail.example.com or ANNA.LEE@MAIL.EXAMPLE.COM, call +1 (017) 555-7713 or +1 017 555 7713 now.",
    "Card 4539578763621486 and 4539 5787 6362 1486, other 9807915762804490, host 97.51.17.173. SSN 078-05-1120",
    "Mr John Smith met Mrs Mary Smith and Mr Smith. Frau Ünal, г-н Иван Петров, κυρία Μαρία Παππά",
    "nothing here, version 1.2, 3 apples and the year 1999", "", None,
]


def run(spark, texts, key=b"k"):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, spans string")
    return {r.doc_id: r for r in S.replace(docs.repartition(2), key).collect()}


def test_formats_and_coreference(spark):
    out = run(spark, TEXTS)
    assert len(out) == len(TEXTS)
    a = out[0]
    lower, upper = re.findall(r"\S+@[^\s,]+", a.text)
    assert lower.upper() == upper and "anna" not in lower and a.n_entities == 4
    one, two = re.search(r"call (\+1 \(\d{3}\) \d{3}-\d{4}) or (\+1 \d{3} \d{3} \d{4}) now", a.text).groups()
    assert re.sub(r"\D", "", one) == re.sub(r"\D", "", two) != "10175557713"
    b = out[1].text
    x, y, z, ip = re.search(r"Card (\d{16}) and ((?:\d{4} ?){4}), other (\d{16}), host ([\d.]+)\. SSN \d{3}-\d{2}-\d{4}$", b).groups()
    assert x == y.replace(" ", "") and S._luhn(x) and not S._luhn(z) and ip != "97.51.17.173"
    c = re.search(r"Mr (\w+) (\w+) met Mrs (\w+) (\w+) and Mr (\w+)\. Frau (\w+), г-н (\w+) (\w+), κυρία (\w+) (\w+)$", out[2].text).groups()
    assert c[1] == c[3] == c[4] and c[0] != c[2] and c[0].endswith("n") and c[2].endswith("a")
    assert all("а" <= ch.lower() <= "я" for ch in c[6] + c[7]) and all("Ͱ" <= ch <= "Ͽ" for ch in c[8] + c[9])
    assert out[3].text == TEXTS[3] and out[3].n_entities == 0 and out[4].text == out[5].text == ""
    for r in out.values():
        for mark in filter(None, r.spans.split(",")):
            kind, s, e = mark.split(":")
            assert 0 <= int(s) < int(e) <= len(r.text)
    assert {i: r.text for i, r in run(spark, TEXTS).items()} == {i: r.text for i, r in out.items()}
    assert run(spark, TEXTS, b"other")[0].text != a.text


def test_collisions_are_drawn_again(spark):
    """First draws that all are entities or meet in pairs."""
    rows = [("ip", f"10.0.0.{i}") for i in range(60)]

    def draws(kind, canonical, key, attempt):
        last = int(canonical.rsplit(".", 1)[1])
        return (f"10.0.0.{last // 2}", f"10.0.1.{last // 2}", f"10.0.{attempt}.{last}")[min(attempt, 2)]

    out = {r.canonical: r.surrogate for r in S.assign(spark.createDataFrame(rows, "kind string, canonical string"), b"k", draws).collect()}
    assert len(out) == len(set(out.values())) == 60
    assert set(out.values()) == {f"10.0.1.{i}" for i in range(30)} | {f"10.0.2.{i}" for i in range(1, 60, 1) if out[f"10.0.0.{i}"].startswith("10.0.2")}
    assert not set(out.values()) & {c for _, c in rows}


@pytest.mark.parametrize("rows", [[], [(None, "a@b.com", None), (1, "a@b.com", None), (1, "a@b.com", None)]])
def test_empty_and_repeated(spark, rows):
    out = S.replace(spark.createDataFrame(rows, "doc_id long, text string, spans string"), b"k").collect()
    assert len(out) == len(rows) and len({r.text for r in out}) == bool(rows)


def test_bare_mentions_of_a_titled_person(spark):
    text = "Mr John Smith called. Smith said that JOHN SMITH, Smith's brother and smith@a.example.org met Mrs Jane O'Neil-Smith. A smith, Johnson."
    out = run(spark, [text, "Smith said"])
    r = out[0]
    given, family, a, b, c, d = re.match(r"Mr (\w+) (\w+) called\. (\w+) said that (\w+) (\w+), (\w+)'s brother", r.text).groups()
    assert family == a == d and c == family.upper() and b == given.upper() and given != "John" and family != "Smith"
    assert r.text.endswith("A smith, Johnson.") and "smith@" not in r.text and "O'Neil" not in r.text and r.n_entities == 9
    assert out[1].text == "Smith said"


def test_international_numbers_and_ipv6(spark):
    texts = ["Call +14155552671 or +1 415 555 2671, +4915123456789 too.", "From 2001:0DB9:0::8a2e:370:7334 and 2001:db9::8a2e:370:7334 at 12:30:45, a::b."]
    out = run(spark, texts)
    one, two, three = re.match(r"Call (\+1\d{10}) or (\+1 \d{3} \d{3} \d{4}), (\+49\d{11}) too\.$", out[0].text).groups()
    assert one == two.replace(" ", "") != "+14155552671" and three != "+4915123456789"
    assert {m.split(":")[0] for m in out[0].spans.split(",")} == {"phone"}
    x, y = re.match(r"From (\S+) and (\S+) at 12:30:45, a::b\.$", out[1].text).groups()
    assert x == y and x.startswith("2001:db8:")
