import math
import zlib
from collections import Counter

import numpy as np
import pytest

from rollcall.llm import hmm
from tests.conftest import rows
from tests.llm.conftest import documents, texts_of

QUICK = hmm.Settings(states=3, iterations=2)


def tiny(states=3, classes=5, seed=1):
    rng = np.random.default_rng(seed)
    norm = lambda x, axis: x / x.sum(axis, keepdims=True)
    return hmm.Model(QUICK, norm(rng.random(states), 0), norm(rng.random((states, states)), 1), norm(rng.random((classes, states)), 0))


def every_path(model, text):
    """The probability of a sequence, summed over all state paths."""
    paths = {(): 1.0}
    for t, c in enumerate(text):
        step = {}
        for path, p in paths.items():
            for s in range(len(model.start)):
                move = model.start[s] if t == 0 else model.move[path[-1], s]
                step[(*path, s)] = p * move * model.emit[c, s]
        paths = step
    return paths


@pytest.mark.parametrize("every, segment", [(1, 99), (2, 99), (16, 99), (1, 1), (2, 2), (16, 3), (2, 5)])
def test_forward_recursion_is_exact(monkeypatch, every, segment):
    monkeypatch.setattr(hmm, "EVERY", every)
    monkeypatch.setattr(hmm, "SEGMENT", segment)
    model = tiny()
    texts = [np.array(t, np.uint16) for t in ([0], [1, 0], [4, 4, 2, 0], [3, 1, 2, 2, 4, 0], [2, 0])]
    got = hmm.log_likelihoods(model, texts)
    want = [math.log10(sum(every_path(model, t).values())) for t in texts]
    assert np.allclose(got, want, atol=1e-9)


@pytest.mark.parametrize("every, segment", [(1, 99), (2, 99), (16, 99), (1, 1), (2, 2), (16, 3), (2, 5)])
def test_expected_counts_are_those_of_all_paths(monkeypatch, every, segment):
    monkeypatch.setattr(hmm, "EVERY", every)
    monkeypatch.setattr(hmm, "SEGMENT", segment)
    model, texts = tiny(), [np.array(t, np.uint16) for t in ([0], [1, 3, 0], [4, 4, 2, 0], [2, 2, 1, 3, 4, 1, 0])]
    start, move, emit = np.zeros(3), np.zeros((3, 3)), np.zeros((5, 3))
    hmm.expected_counts(model, texts, start, move, emit)
    s2, m2, e2 = np.zeros(3), np.zeros((3, 3)), np.zeros((5, 3))
    for t in texts:
        paths = every_path(model, t)
        total = sum(paths.values())
        for path, p in paths.items():
            s2[path[0]] += p / total
            for a, b in zip(path, path[1:], strict=False):
                m2[a, b] += p / total
            for c, s in zip(t, path, strict=True):
                e2[c, s] += p / total
    assert np.allclose(start, s2) and np.allclose(move, m2) and np.allclose(emit, e2)


def test_long_and_many_texts_do_not_underflow():
    model = tiny()
    rng = np.random.default_rng(2)
    texts = [rng.integers(0, 5, n).astype(np.uint16) for n in (200_000, *[3] * 2000, 700)]
    got = hmm.log_likelihoods(model, texts)
    assert np.isfinite(got).all() and np.allclose(got[1], hmm.log_likelihoods(model, [texts[1]])[0])


def test_a_very_long_text_is_trained_on_in_bounded_memory(monkeypatch):
    """What is held beside the text is some arrays of one segment, not of the whole recursion (6 MB each)."""
    import tracemalloc

    monkeypatch.setattr(hmm, "SEGMENT", 1 << 10)
    model = tiny(states=8, classes=50)
    text = np.random.default_rng(3).integers(0, 50, 100_000).astype(np.uint16)
    start, move, emit = np.zeros(8), np.zeros((8, 8)), np.zeros((50, 8))
    tracemalloc.start()
    hmm.expected_counts(model, [text], start, move, emit)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 6e6
    assert start.sum() == pytest.approx(1) and move.sum() == pytest.approx(len(text) - 1) and emit.sum() == pytest.approx(len(text))
    assert np.allclose(emit.sum(1), np.bincount(text, minlength=50))


@pytest.mark.parametrize("size", [1, 7, 40, 10_000])
def test_words_in_parts(size):
    text = "One two\tthree\x1cfour  \n Fünf\x0b" * 30 + "x" * 90 + " Y"
    assert [w for part in hmm.word_parts(text, size) for w in part] == hmm.words_of(text)


@pytest.mark.parametrize("head", [1, 7, 100, 1999, 2000, 2003, 5000])
def test_the_head_is_full(spark, head):
    """Also when most words are equally frequent."""
    counts = [(f"w{i}".encode(), 1) for i in range(2000)] + [(b"often", 9), (b"twice", 2), (b"too", 2)]
    found = hmm.frequent(spark.createDataFrame(counts, "word binary, n long"), head)
    assert len(found) == len({w for w, _ in found}) == min(head, 2003)
    assert [n for _, n in found] == sorted((n for _, n in counts), reverse=True)[:head]


def test_classes_of_rare_words_make_one_distribution(spark, monkeypatch):
    monkeypatch.setattr(hmm, "RARE_WORDS", 5)
    counts = Counter({f"w{i}".encode(): 1 + i % 4 for i in range(200)} | {b"head": 500, b"too": 400})
    df = spark.createDataFrame(list(counts.items()), "word binary, n long")
    words = hmm.vocabulary(df, 30, 2, 4096)
    assert words.n_rare == 40 and words.tokens == counts.total() + 30 and words.distinct == 203
    assert words.counts[1:41].sum() == counts.total() - 900 and words.rare_distinct.sum() == 200
    classes = words.classes([b"head", b"w1", b"unknown", b"too"])
    assert sorted(classes[[0, 3]].tolist()) == [41, 42] and classes[1] == 1 + zlib.crc32(b"w1") % 40
    for k in range(40):  # known words of a class and all unknown ones together
        own = [n for w, n in counts.items() if w not in words.head and zlib.crc32(w) % 40 == k]
        assert sum(n + 1 for n in own) + 1 == words.rare_base[k]
    assert words.unigram.sum() == pytest.approx(1)


def check_base(df, texts, **how):
    got = {r["doc_id"]: r for r in hmm.scored(df, settings=QUICK, **how).collect()}
    held = {k: k is not None and zlib.crc32(str(k).encode()) % 7 == 2 for k in texts}
    tokens = {k: [*(t or "").encode().lower().split(), None] for k, t in texts.items()}
    c = Counter(w for k, t in tokens.items() if not held[k] for w in t)
    n, v = sum(c.values()), len(c)
    assert set(got) == set(texts)
    for k, t in tokens.items():
        base = sum(math.log10((c[w] + 1) / (n + v + 1)) for w in t)
        r = got[k]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held[k], len(t), sum(c[w] > 0 for w in t), n)
        assert r["base_score"] == pytest.approx(base, rel=1e-9) and r["score"] < 0
    return got


def test_whole_table_and_better_than_unigrams(spark):
    df = documents(spark)
    got = check_base(df, texts_of(df))
    held = [r for r in got.values() if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_rare_words_keep_a_proper_distribution(spark):
    texts = {i: f"a b c w{i % 13} v{i}" for i in range(60)}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    check_base(df, texts)
    small = hmm.Settings(states=2, head=4, iterations=1)
    got = {r["doc_id"]: r for r in hmm.scored(df, settings=small).collect()}
    # with few classes the base score is the same, and probabilities of all words still sum to one
    assert got[1]["base_score"] == pytest.approx(check_base(df, texts)[1]["base_score"])
    learnt = [t for i, t in texts.items() if zlib.crc32(str(i).encode()) % 7 != 2]
    counts = Counter(w for t in learnt for w in t.encode().split())
    rare = Counter(dict(sorted(counts.items(), key=lambda x: (-x[1], x[0]))[4:]))
    assert sum((n + 1) for n in rare.values()) + 1 == rare.total() + len(rare) + 1


def test_training_raises_the_likelihood(spark):
    texts = {i: " ".join(["a b"] * 6 if i % 2 else ["c d d"] * 4) for i in range(80)}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    totals = []
    for n in (0, 1, 4, 12):
        scored = hmm.scored(df, settings=hmm.Settings(states=4, iterations=n, prior=0.1))
        totals.append(sum(r["score"] for r in scored.filter("not held_out").collect()))
    assert totals == sorted(totals) and totals[-1] > 0.7 * totals[0]


def test_odd_rows(odd, nothing):
    got = sorted(rows(hmm.scored(odd, settings=QUICK)), key=str)
    assert len(got) == odd.count() and sum(r[2] == 1 for r in got) == 4
    assert rows(hmm.scored(nothing, settings=QUICK)) == []
