import random
from collections import defaultdict

import numpy as np
import pytest

from rollcall.llm import near
from rollcall.llm.common import WordHashes
from rollcall.llm.components import components
from tests.conftest import rows
from tests.llm.conftest import documents, texts_of


def plain_set(text):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def plain_groups(texts):
    """Every pair compared that shares a shingle."""
    sets = {k: plain_set(t) for k, t in texts.items()}
    holders, home = defaultdict(list), {k: k for k in sets}

    def top(k):
        while home[k] != k:
            home[k] = home[home[k]]
            k = home[k]
        return k

    for k, s in sets.items():
        for g in s:
            holders[g].append(k)
    seen = set()
    for members in holders.values():
        for i, a in enumerate(members):
            for b in members[i + 1 :]:
                if (a, b) not in seen:
                    seen.add((a, b))
                    both = len(sets[a] & sets[b])
                    if 100 * both >= 85 * (len(sets[a]) + len(sets[b]) - both):
                        x, y = top(a), top(b)
                        home[max(x, y)] = min(x, y)
    return {k: (len(s), top(k)) for k, s in sets.items()}


def check(df, texts, settings=near.Settings()):
    got = {k: (n, c, kept) for k, n, c, kept in rows(near.near_groups(df, settings=settings))}
    want = plain_groups(texts)
    assert got == {k: (n, c, c == k) for k, (n, c) in want.items()}
    return want


def test_whole_table(spark):
    df = documents(spark)
    assert sum(c != k for k, (_, c) in check(df, texts_of(df)).items()) > 50


def family(seed, size, edits, length=120):
    """Copies of one text with 0 to `edits` words changed, so that links form chains."""
    rnd = random.Random(seed)
    base = [f"s{seed}w{rnd.randrange(10_000)}" for _ in range(length)]
    out = []
    for i in range(size):
        words = list(base)
        for _ in range(rnd.randint(0, edits)):
            words[rnd.randrange(length)] = f"x{rnd.randrange(10_000)}"
        out.append(" ".join(words))
    return out


@pytest.mark.parametrize("depth", [0, 2, 4, 6])
def test_trees_reach_the_recall_at_full_depth(depth):
    s = near.Settings(depth=depth)
    assert (1 - s.similarity * 0.93**depth) ** s.trees <= 1 - s.recall


@pytest.mark.parametrize("settings", [near.Settings(leaf_shingles=3000), near.Settings(leaf=16, depth=0, leaf_shingles=3000)])
def test_a_heavy_cluster_is_never_in_one_row(spark, monkeypatch, settings):
    whole = near.linked

    def bounded(sets, percent):
        assert sum(map(len, sets)) <= 3000
        return whole(sets, percent)

    monkeypatch.setattr(near, "linked", bounded)
    texts = dict(enumerate(family(1, 40, 8, 400) + family(2, 60, 3) + family(3, 9, 3)))
    want = check(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), texts, settings)
    assert len({c for _, c in want.values()}) < len(texts) / 2


@pytest.mark.parametrize(
    "settings",
    [near.Settings(), near.Settings(leaf=16), near.Settings(leaf=16, depth=0), near.Settings(leaf_shingles=500, depth=1)],
)
def test_large_families_shared_passages_and_copies(spark, settings):
    rnd = random.Random(5)
    passage = " ".join(f"common{i}" for i in range(60))
    texts = [t for seed, size in ((1, 150), (2, 40), (3, 2)) for t in family(seed, size, 8)]
    texts += [passage + " " + " ".join(f"own{rnd.randrange(10**6)}" for _ in range(40)) for _ in range(150)]
    texts += ["the very same short text of it"] * 60 + ["Too short", "too  SHORT", "a b", ""] + family(9, 3, 0, 4000)
    rnd.shuffle(texts)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    check(df, dict(enumerate(texts)), settings)


def sizes(spark, texts, settings):
    """Classes in all leaves together, and in the largest one."""
    df = spark.createDataFrame(list(enumerate(texts)), "rep long, text string")
    full = near._sets_of(df.withColumnRenamed("rep", "id"), settings).withColumnRenamed("id", "rep")
    leaves, settled = near._leaves(full, df, settings)
    found = [len(r["left"]) + len(r["right"]) for r in leaves.collect()]
    return sum(found), max(found, default=0), settled


@pytest.mark.parametrize("depth", [0, 3])
def test_a_family_that_is_settled_costs_its_size(spark, depth):
    settings = near.Settings(leaf=16, depth=depth)
    few, many = (sizes(spark, family(1, n, 3, 400), settings) for n in (150, 1200))
    assert many[0] < 3 * few[0] + 1200 * settings.trees and many[1] <= 16  # blocks all against all: 64 times
    assert rows(many[2].groupBy("component").count()) == [(0, 1200)]


def test_what_is_not_settled_meets_all(spark):
    # two families whose members chain, and loose ones between them that share most shingles but too few
    rnd = random.Random(3)
    texts = family(4, 120, 3, 300) + family(4, 60, 16, 300) + family(4, 30, 40, 300) + family(5, 70, 10, 200)
    rnd.shuffle(texts)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for settings in (near.Settings(leaf=16, depth=1), near.Settings(leaf=8, depth=0, pivots=2, chunk=5)):
        want = check(df, dict(enumerate(texts)), settings)
        assert 3 < len({c for _, c in want.values()}) < len(texts)


def test_threshold_is_met_exactly():
    # 17 of 20 is 85 in 100; 16 of 19 is less
    sets = [np.arange(20, dtype=np.uint64), np.arange(3, 20, dtype=np.uint64), np.arange(100, 119, dtype=np.uint64), np.arange(103, 119, dtype=np.uint64)]
    assert near.linked(sets, 85) == [0, 0, 2, 3]
    many = [*sets, *(np.arange(1000 * i, 1000 * i + 50, dtype=np.uint64) for i in range(1, 20))]
    assert near.linked(many, 85)[:4] == [0, 0, 2, 3] and near.linked(many, 85)[4:] == list(range(4, 23))


def test_sets_are_those_of_plain_words():
    texts = ["A b\x0bC d\x1ce\x85 f g", "", " \t", "x y", "X  y", "y x", "é É ß", "a a a a a a a a"]
    sets = near.shingle_sets(texts, WordHashes(), 5)
    assert [len(s) for s in sets] == [len(plain_set(t)) for t in texts]
    assert sets[3].tolist() == sets[4].tolist() != sets[5].tolist()


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 63, 2000, np.uint64)
    other = np.concatenate([base[:1700], rng.integers(0, 1 << 63, 100, np.uint64)])
    a, b = near.signatures([np.unique(base), np.unique(other)], 512)
    assert abs((a == b).mean() - 1700 / 2100) < 0.06


def test_odd_rows(odd, nothing):
    got = sorted(rows(near.near_groups(odd)), key=str)
    by = defaultdict(list)
    for key, n, component, kept in got:
        by[key].append((n, component, kept))
    assert by[1] == [(3, 1, True)] and by[2] == [(3, 1, False)] * 2
    assert by[3] == [(0, 3, True)] and by[4] == [(0, 4, True)] and by[5] == [(0, 5, True)]
    assert sorted(by[None]) == [(0, None, True), (1, None, True)] and by[7] == [(1, 7, True)]
    left = near.without_near_copies(odd)
    assert left.columns == odd.columns and left.count() == odd.count() - 2
    assert rows(near.near_groups(nothing)) == [] and rows(near.without_near_copies(nothing)) == []


def test_components_of_chains_stars_and_rings(spark):
    pairs = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(200, 201), (201, 202), (202, 200), (5, 5)]
    got = dict(rows(components(spark.createDataFrame(pairs, "a long, b long"))))
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}, **{i: 200 for i in (200, 201, 202)}}
    assert rows(components(spark.createDataFrame([], "a long, b long"))) == []
