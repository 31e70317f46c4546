import math
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rollcall.llm import lexical, queries
from tests.conftest import rows
from tests.llm.conftest import SMALL, documents

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(_LOWER))


def plain(docs, items, k=20):
    """(item id, rank, doc id, score) by scoring every document for every item."""
    held = [(key, Counter(terms(text))) for key, text in docs]
    held = [(key, tf) for key, tf in held if tf]
    n, total = len(held), sum(sum(tf.values()) for _, tf in held)
    df = Counter(t for _, tf in held for t in tf)
    out = []
    for item, text in items:
        scores = []
        for key, tf in held:
            m = 75 + 25 * sum(tf.values()) * n // total
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * tf[t] // (1000 * tf[t] + 12 * m))
                for t in terms(text) if tf[t]
            )
            if score > 0:
                scores.append((-score, key is None, key))
        best = sorted(scores, key=lambda s: (s[0], s[1], s[2] or 0))[:k]
        out += [(item, i, key, -score) for i, (score, _, key) in enumerate(best, 1)]
    return out


def known(found):
    return sorted(found, key=lambda r: tuple((x is None, x or 0) for x in r))


@settings(max_examples=300, deadline=None)
@given(st.text(st.characters(codec="utf-8"), max_size=60), st.integers(1, 9))
def test_terms_of_any_text(text, size):
    raw = text.encode()
    whole, _ = lexical.term_hashes(np.frombuffer(raw, np.uint8))
    assert len(whole) == len(terms(text))
    assert [h for t in terms(text) for h in lexical.term_hashes(np.frombuffer(t.encode(), np.uint8))[0]] == whole.tolist()
    parts = [lexical.term_hashes(np.frombuffer(p, np.uint8))[0] for p in lexical.windows(raw, size)]
    assert np.concatenate(parts).tolist() == whole.tolist()


@settings(max_examples=300, deadline=None)
@given(st.integers(0, 10_000), st.integers(1, 6))
def test_limited_accumulators_lose_nothing(seed, k):
    rng = np.random.default_rng(seed)
    n = int(rng.integers(1, 60))
    lists = []
    for _ in range(int(rng.integers(1, 8))):
        docs = np.flatnonzero(rng.random(n) < rng.choice([0.05, 0.3, 0.9]))
        lists.append((docs, rng.integers(0, rng.choice([2, 10, 1000]), len(docs))))
    lists.sort(key=lambda x: len(x[0]))
    full = np.zeros(n, np.int64)
    for docs, gain in lists:
        full[docs] += gain
    want = sorted((-s, i) for i, s in enumerate(full.tolist()) if s > 0)[:k]
    best, scores = lexical.top_documents(lists, n, k)
    assert list(zip((-scores).tolist(), best.tolist(), strict=True)) == want


def test_accumulators_stop():
    """A frequent, light last term creates no accumulators."""
    rare = (np.arange(30), np.full(30, 100))
    common = (np.arange(1000), np.full(1000, 1))
    best, scores = lexical.top_documents([rare, common], 1000, 5)
    assert best.tolist() == [0, 1, 2, 3, 4] and set(scores.tolist()) == {101}


@pytest.mark.parametrize("shard, block", [(1 << 16, 1 << 20), (70, 3000)])
def test_whole_table_as_plain(spark, shard, block):
    docs, items = documents(spark), spark.read.parquet(f"{SMALL}/benchmark.parquet")
    want = plain(rows(docs, "doc_id", "text"), rows(items, "item_id", "text"))
    assert known(rows(lexical.ranked(docs, items, shard_docs=shard, block_bytes=block))) == known(want)


def test_query_as_sql(spark):
    for name in ("documents", "benchmark"):
        duckdb.sql(f"CREATE OR REPLACE VIEW {name} AS FROM '{SMALL}/{name}.parquet'")
    want = duckdb.sql(queries.SQL["op12_ranked_search"]).fetchall()
    got = queries.op12_ranked_search(spark, SMALL)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert known(rows(got)) == known(want) and len(want) == 800


def test_few_documents_and_ties(spark):
    docs = [(5, "b a"), (3, "a b"), (9, "A, b!"), (1, "c"), (2, "zz " * 40), (4, "Émile émile"), (7, "b-a x1")]
    items = [(1, "a b"), (2, "nothing here"), (3, "ÉMILE Émile"), (4, "a a b"), (5, "")]
    made = lexical.ranked(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), k=2)
    assert known(rows(made)) == known(plain(docs, items, k=2))
    assert [r[2] for r in known(rows(made)) if r[0] == 1] == [3, 5]


def test_odd_rows(spark, odd, nothing):
    items = spark.createDataFrame([(1, "one TWO three"), (None, "word"), (2, None), (3, ""), (1, "without wörtchen")], "item_id long, text string")
    items = items.withColumn("row", F.lit(0)).withColumn("item", F.lit(1)).withColumn("score", F.lit(2))
    want = plain(rows(odd, "doc_id", "text"), rows(items, "item_id", "text"))
    assert any(r[2] is None for r in want)
    odd = odd.withColumn("keys", F.lit(1)).withColumn("salt", F.lit(1)).withColumn("rank", F.lit(1))
    assert known(rows(lexical.ranked(odd, items))) == known(want)
    assert rows(lexical.ranked(nothing, items)) == [] == rows(lexical.ranked(odd, items.limit(0)))
    assert rows(lexical.ranked(odd.where("text is null"), items)) == []


def test_a_very_long_text(spark):
    text = "alpha " * 400_000 + "omega" + "β" * 100_000
    docs = [(1, text), (2, "omega alpha"), (3, "β")]
    items = [(1, "omega"), (2, "alpha β" + "β" * 99_999)]
    made = lexical.ranked(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert known(rows(made)) == known(plain(docs, items))


def test_large_numbers_stay_exact():
    many = lexical.Collection(10**12, 3 * 10**14, np.array([5]))
    assert many.lengths(np.array([10**8, 300])).tolist() == [75 + 25 * 10**8 // 300, 100]
