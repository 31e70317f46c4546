import hashlib
from collections import Counter
from functools import cache
from itertools import accumulate

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rollcall.llm import alignment as al
from rollcall.llm import queries
from tests.llm.conftest import SMALL, documents, texts_of


@cache
def tokenizers():
    return al.Tokenizers(*queries.aligned_tokenizers())


@cache
def small_aligner():
    return al.Aligner(tokenizers(), most=300)


def plain(text):
    """Whole text, token by token: A ids, B ids, groups as text, and the links as (A id, B id) with their numbers."""
    t, full = tokenizers(), (" " + (text or "")).encode()
    a = t.a.encode(" " + (text or ""), add_special_tokens=False).ids if text else []
    b = t.b.encode(text) if text else []
    sizes = [[len(t.a_bytes[i]) for i in a], [len(t.b_bytes[i]) for i in b]]
    if not text or b"".join(t.a_bytes[i] for i in a) != full or b"".join(t.b_bytes[i] for i in b) != full:
        return [], [], "", Counter()
    ends = [list(accumulate(s)) for s in sizes]
    groups, links, i, j = [], Counter(), 0, 0
    for c in sorted(set(ends[0]) & set(ends[1])):
        i2, j2 = i, j
        while i2 < len(a) and ends[0][i2] <= c:
            i2 += 1
        while j2 < len(b) and ends[1][j2] <= c:
            j2 += 1
        groups.append(f"{','.join(map(str, a[i:i2]))}|{','.join(map(str, b[j:j2]))}")
        for x in range(i, i2):
            for y in range(j, j2):
                if max(ends[0][x] - sizes[0][x], ends[1][y] - sizes[1][y]) < min(ends[0][x], ends[1][y]):
                    links[a[x], b[y]] += 1
        i, j = i2, j2
    return a, b, ";".join(groups), links


def plain_table(texts):
    """Rows of the query, in the order of the texts."""
    found = [plain(t) for t in texts]
    counts = sum((f[3] for f in found), Counter())
    highest = {}
    for (_, b), n in counts.items():
        highest[b] = max(n, highest.get(b, 0))
    rows = []
    for a, b, groups, links in found:
        best = sum(n for p, n in links.items() if counts[p] == highest[p[1]])
        total = sum(n * counts[p] for p, n in links.items())
        sha = hashlib.sha256(groups.encode()).hexdigest() if groups else ""
        rows.append((len(a), len(b), groups.count(";") + bool(groups), sum(links.values()), best, total, sha))
    return rows


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.booleans(), min_size=1, max_size=80), st.lists(st.booleans(), min_size=1, max_size=80))
def test_groups_and_links(a, b):
    n = max(len(a), len(b))
    a_ends, b_ends = (np.array(sorted({i + 1 for i, x in enumerate(s) if x} | {n})) for s in (a, b))
    got_a, got_b = al.groups_of(a_ends, b_ends)
    common = sorted(set(a_ends.tolist()) & set(b_ends.tolist()))
    assert got_a.tolist() == np.searchsorted(common, a_ends).tolist()
    assert got_b.tolist() == np.searchsorted(common, b_ends).tolist()
    spans = [list(zip([0, *e[:-1].tolist()], e.tolist(), strict=True)) for e in (a_ends, b_ends)]
    want = {(i, j) for i, x in enumerate(spans[0]) for j, y in enumerate(spans[1]) if max(x[0], y[0]) < min(x[1], y[1])}
    links = list(zip(*(x.tolist() for x in al.links_of(a_ends, b_ends)), strict=True))
    assert set(links) == want and len(links) == len(want)


WORDS = ["a", "the", " ", "  ", "\n", "\n\n", "\t", "é", "ñandú", ".", ",", "...", "3.14", "don't", "　", "\xa0", " ",
         "中文", "😀", "к", "Привет", "<|endoftext|>", "</s>", "▁", "\0", "_", "×", "²", "\r\n", "\x85", "é", "word."]


@settings(max_examples=500, deadline=None)
@given(st.lists(st.sampled_from(WORDS) | st.text(st.characters(codec="utf-8"), max_size=4), max_size=30).map("".join))
def test_any_text_as_the_libraries(text):
    (row,) = al.align_texts([text], small_aligner(), window=40)
    a, b, groups, links = plain(text)
    want = len(a), len(b), groups.count(";") + bool(groups), sum(links.values())
    assert row[:4] == want and row[4] == (hashlib.sha256(groups.encode()).hexdigest() if groups else "")
    assert Counter(al.unpack_links(row[5]).tolist()) == Counter({x << 15 | y: n for (x, y), n in links.items()})


def test_tokenizers_that_prove_nothing_take_whole_texts():
    t = al.Tokenizers(*queries.aligned_tokenizers())
    t.by_words = t.by_stops = False
    rows = list(al.align_texts(["one two", "", "three, four."], al.Aligner(t)))
    assert rows == list(al.align_texts(["one two", "", "three, four."], al.Aligner(tokenizers())))


def test_whole_table_as_the_libraries(spark):
    texts = texts_of(documents(spark))
    want = dict(zip(texts, plain_table(texts.values()), strict=True))
    got = {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in queries.op11_token_alignment(spark, SMALL).collect()}
    assert got == want


@pytest.mark.parametrize("most", [0, 40, 4000])
def test_pairs_that_are_not_broadcast(spark, most):
    """Counts that come by the join instead are the same."""
    texts = texts_of(documents(spark).limit(60))
    docs = spark.createDataFrame(list(texts.items()), "k long, body string").repartition(5)
    got = al.aligned(docs, *queries.aligned_tokenizers(), "k", "body", most_hot=most)
    assert {r["k"]: tuple(r[c] for c in COLUMNS) for r in got.collect()} == dict(zip(texts, plain_table(texts.values()), strict=True))


def test_odd_rows(spark, odd, nothing):
    pair = queries.aligned_tokenizers()
    rows = odd.select("doc_id", "text").collect()
    want = sorted(zip([str(r[0]) for r in rows], plain_table([r[1] for r in rows]), strict=True))
    got = sorted((str(r["doc_id"]), tuple(r[c] for c in COLUMNS)) for r in al.aligned(odd, *pair).collect())
    assert got == want
    assert al.aligned(nothing, *pair).collect() == []
    clash = odd.withColumn("row", F.lit(1)).withColumn("pair", F.lit(2)).withColumn("links", F.lit("x"))
    assert sorted(str(r["doc_id"]) for r in al.aligned(clash, *pair).collect()) == [x[0] for x in want]


def test_a_very_long_text():
    text = " ".join(f"wörd{i % 977}, x" for i in range(200_000)) + "y" * 3000
    (row,) = al.align_texts([text], al.Aligner(tokenizers()))
    a, b, groups, _ = plain(text)
    assert row[:2] == (len(a), len(b)) and row[4] == hashlib.sha256(groups.encode()).hexdigest()
