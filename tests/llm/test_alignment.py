"""Alignments against boundaries looked up one by one, counts against plain dictionaries."""

import collections
import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyspark.llm import alignment as al
from tallyspark.llm.queries import QUERIES, table, vocabulary

SF = "/root/testdata/sf0.001"
A, B = vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def tools():
    import sentencepiece
    from tokenizers import Tokenizer

    first, second = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    first.encode_special_tokens = True
    return first, second


def groups_of(text, tools):
    """Groups of ids, from the sets of ends of both sides."""
    if not text:
        return []
    first, second = tools
    alphabet = al.byte_alphabet()
    a = [(i, bytes(alphabet[c] for c in first.id_to_token(i))) for i in first.encode(" " + text, add_special_tokens=False).ids]
    b = []
    for i in second.encode(text):
        p = second.id_to_piece(i)
        b.append((i, bytes([int(p[3:5], 16)]) if len(p) == 6 and p[:3] == "<0x" else p.replace("▁", " ").encode()))
    raw = (" " + text).encode()
    if b"".join(t for _, t in a) != raw or b"".join(t for _, t in b) != raw:
        return []

    def ends(side):
        at = 0
        for i, t in side:
            at += len(t)
            yield i, at

    a, b = list(ends(a)), list(ends(b))
    cuts = {e for _, e in a} & {e for _, e in b}
    out = [([], [])]
    for side, tokens in enumerate((a, b)):
        at = 0
        for i, e in tokens:
            if at == len(out):
                out.append(([], []))
            out[at][side].append(i)
            at += e in cuts
    return out


def brute(rows, tools):
    """Rows of the report in the order of ``rows`` of (doc_id, text)."""
    aligned = [groups_of(t, tools) for _, t in rows]
    links = [collections.Counter((x, y) for a, b in g for x in a for y in b) for g in aligned]
    count = collections.Counter(p for per in links for p in per)
    best = {}
    for (x, _), n in count.items():
        best[x] = max(best.get(x, 0), n)
    out = []
    for (i, _), g, per in zip(rows, aligned, links, strict=True):
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g)
        out.append((i, sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), sum(per.values()),
                    sum(n for p, n in per.items() if count[p] == best[p[0]]), sum(n * count[p] for p, n in per.items()),
                    hashlib.sha256(text.encode()).hexdigest() if g else ""))
    return out


def test_byte_alphabet_is_the_vocabulary_s(tools):
    assert sorted(al.byte_alphabet().values()) == list(range(256))
    used = {c for t, i in tools[0].get_vocab().items() if i != 50256 for c in t}
    assert used == set(al.byte_alphabet())


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 6), min_size=1, max_size=40), st.data())
def test_coalescing_equals_common_ends(a, data):
    n = sum(a)
    cuts = sorted(data.draw(st.sets(st.integers(1, max(n - 1, 1)))) - {n}) if n > 1 else []
    a_end, b_end = np.cumsum(a), np.array([*cuts, n])
    ga, gb = al.coalesce(np.append(0, a_end[:-1]), a_end, np.append(0, b_end[:-1]), b_end)
    common = sorted(set(a_end.tolist()) & set(b_end.tolist()))
    assert ga.tolist() == [int(np.searchsorted(common, e)) for e in a_end]
    assert gb.tolist() == [int(np.searchsorted(common, e)) for e in b_end]


def test_query_equals_brute_force(spark, tools):
    rows = [(r.doc_id, r.text) for r in table(spark, SF, "documents").select("doc_id", "text").collect()]
    got = QUERIES["op11_alignment"](spark, SF)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(map(tuple, got.collect())) == sorted(brute(rows, tools))


@settings(max_examples=200, deadline=None)
@given(st.text(st.one_of(st.sampled_from(" \n\t'strevml.,1aé日👩"), st.characters(codec="utf-8")), max_size=60))
def test_quick_encoder_equals_the_library(text):
    pair = al.load(A, B)
    assert pair.quick is not None
    assert pair.encode_bytes(text) == pair.byte_level.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("text", [" " * 300_000, "\n \t" * 100_000, "a" * 300_000, "^" * 300_000, "é " * 100_000])
def test_very_long_texts(text, tools):
    pair = al.load(A, B)
    kept, found = al.align_texts([text, "end"], pair)
    ends = [set(np.cumsum(pair.a_length[found.a[: found.a_bounds[1]]])),
            set(np.cumsum(pair.b_length[found.b[: found.b_bounds[1]]]))]
    assert kept.tolist() == [0, 1] and int(found.group_bounds[1]) == len(ends[0] & ends[1])
    assert pair.encode_bytes(text) == tools[0].encode(text, add_special_tokens=False).ids


ODD = [(None, "one two"), (1, None), (2, ""), (3, " "), (4, "tabs\tand\n\nlines \r\x0b"), (4, "tabs\tand\n\nlines \r\x0b"), (5, "a▁b"), (6, "x\x00y"), (7, "<|endoftext|> <s> </s> <unk> <0x41>"),
       (8, "日本語のテキスト ñandú Ωμέγα 👩‍👩‍👧‍👦 ​﻿"), (9, "=" * 3000), (10, "0123456789" * 300), (11, "word " * 3000), (12, "é" * 700), (13, "ﬁ ½ ①  é")]


def test_odd_rows(spark, tools, monkeypatch):
    monkeypatch.setattr(al, "BLOCK_PAIRS", 50)
    docs = spark.createDataFrame([(i, t, 0, [1], "x") for i, t in ODD], "doc_id long, text string, block int, codes array<int>, value string").coalesce(2)
    got = al.link_report(docs, A, B).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, brute(ODD, tools)))
    assert al.link_report(docs.limit(0), A, B).collect() == []
    assert al.align(docs.limit(0), A, B).collect() == []


def test_alignment_is_written_out(spark, tools):
    docs = spark.createDataFrame(ODD, "doc_id long, text string")
    rows = brute(ODD, tools)
    for r, want in zip(sorted(al.align(docs, A, B).collect(), key=str), sorted(rows, key=str), strict=False):
        assert (r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links) == want[:5]
        assert (hashlib.sha256(r.groups.encode()).hexdigest() if r.groups else "") == want[-1]


def test_large_groups_in_portions(monkeypatch):
    """One group of many tokens a side, pairs listed in small portions, against plain counting."""
    rng = np.random.default_rng(3)
    a, b = rng.integers(0, 40, 900), rng.integers(0, 60, 700)
    small_a, small_b = rng.integers(0, 40, 50), rng.integers(0, 60, 50)
    found = al.Aligned(np.concatenate([small_a, a]), np.concatenate([small_b, b]), np.append(np.arange(50), np.full(900, 50)), np.append(np.arange(50), np.full(700, 50)),
                       np.array([0, 50, 950]), np.array([0, 50, 750]), np.array([0, 50, 51]))
    want = [collections.Counter(zip(small_a, small_b, strict=True)), collections.Counter((x, y) for x in a for y in b)]
    for portion in (7, 1000, 10**7):
        monkeypatch.setattr(al, "LINKS", portion)
        codes, times, pairs = found.id_pairs(100)
        got = [((int(c) // 100, int(c) % 100), int(t)) for c, t in zip(codes, times, strict=True)]
        assert pairs.tolist() == [len(w) for w in want]
        assert dict(got[: pairs[0]]) == want[0] and dict(got[pairs[0] :]) == want[1]


def test_packing_of_numbers():
    for values in ([], [0], [1, 255, 256, 2**40, 3]):
        assert al._unpacked(al._packed(np.array(values, np.int64)), len(values)).tolist() == values
