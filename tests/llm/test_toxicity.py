import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from rollcall.llm import queries
from rollcall.llm import toxicity as tox
from tests.conftest import rows

QUICK = tox.Settings(epochs=4, buckets=1 << 12)


def sentences(n, seed=1):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    out = []
    for i in range(n):
        text = [rnd.choice(words) for _ in range(rnd.randint(5, 60))]
        toxic = int(i % 4 == 0)
        if toxic:
            for _ in range(2):
                text.insert(rnd.randrange(len(text)), rnd.choice(["nastyone", "foulness", "nastytwo"]))
        out.append((i, " ".join(text), rnd.choice(["en", "de"]), toxic))
    return out


@pytest.fixture(scope="module")
def model(spark):
    docs = spark.createDataFrame(sentences(1200), "doc_id long, text string, lang string, toxic int")
    return tox.learn(docs, docs.select("doc_id", "toxic"), settings=QUICK)


def test_held_out_accuracy_and_unseen_forms(model):
    score = tox.Scorer(model.network)
    test = sentences(400, seed=2)
    p, y = score([t for _, t, _, _ in test]), np.array([r[3] for r in test])
    assert ((p >= 0.5) == y).mean() > 0.97
    assert score(["w1 w2 w3 nastythree w9"])[0] > score(["w1 w2 w3 w4 w9"])[0]
    # a bad word counts wherever it stands in a long text
    long = ["w5"] * 30_000
    assert score([" ".join([*long, "nastyone", "foulness", *long])])[0] >= 0.5


def test_batches_and_neighbours_do_not_matter(model):
    texts = [t for _, t, _, _ in sentences(50, seed=3)] + ["", "!!!", "nastyone"]
    together = tox.Scorer(model.network)(texts)
    alone = np.array([tox.Scorer(model.network)([t])[0] for t in texts])
    assert np.allclose(together, alone, atol=1e-5) and 0 <= together.min() <= together.max() <= 1


def test_pooling_equals_plain_loops(model):
    net, texts = model.network, ["nastyone w1 w2", "", "w7"]
    numbered = tox.Numbered(net.settings.buckets)
    ids, starts = numbered([tox.words_of(t) for t in texts])
    pooled = net.pool(net.answers(tox.embed(numbered.lists, net.table)), ids, starts)
    for i, text in enumerate(texts):
        vectors = [net.table[tox.word_buckets(w, net.settings.buckets)].mean(0) for w in tox.words_of(text)]
        vectors += [np.zeros(net.settings.dim)] * 3
        want = []
        for w, kernel in zip(net.settings.widths, net.kernel, strict=True):
            lines = [sum(vectors[t + j] @ kernel[j] for j in range(w)) for t in range(len(vectors) - 2)]
            want.append(np.max(lines, axis=0))
        assert np.allclose(pooled[i], np.concatenate(want) + net.bias, atol=1e-4)


def test_learns_only_from_the_training_fold(spark):
    docs = spark.createDataFrame(sentences(300), "doc_id long, text string, lang string, toxic int")
    labels = docs.select("doc_id", "toxic")
    flipped = labels.withColumn(
        "toxic", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, 1 - F.col("toxic")).otherwise(F.col("toxic"))
    )
    a, b = (tox.learn(docs, x, settings=QUICK) for x in (labels, flipped))
    assert np.array_equal(a.network.table, b.network.table) and a.thresholds == b.thresholds
    assert zlib.crc32(b"0") % 5 != 0  # the fold isn't trivial


def test_odd_rows(spark, odd, nothing, model):
    got = tox.with_toxicity(odd, model)
    assert got.count() == odd.count() and got.filter("score is null or score < 0 or score > 1").count() == 0
    assert set(odd.columns) <= set(got.columns)
    assert tox.without_toxic(odd, model).columns == odd.columns
    assert tox.with_toxicity(nothing, model).count() == 0
    none = tox.learn(nothing, spark.createDataFrame([], "doc_id long, toxic int"))
    assert rows(tox.with_toxicity(odd, none).select("score").distinct()) == [(0.0,)]
    labels = spark.createDataFrame([(1, 1), (2, None), (None, 1), (99, 1)], "doc_id long, toxic int")
    assert rows(tox.with_toxicity(odd, tox.learn(odd, labels)).select("predicted").distinct()) == [(1,)]


def test_long_texts_teach_too(spark):
    """All toxic documents are long: windows of them are trained on, and whole texts calibrate."""
    rnd = random.Random(6)
    plain = [f"w{i}" for i in range(400)]
    docs = []
    for i in range(400):
        toxic = i % 3 == 0
        words = rnd.choices(plain, k=6_000 if toxic or i % 7 == 0 else rnd.randint(20, 300))
        if toxic:
            for _ in range(3):
                words.insert(rnd.randrange(len(words)), rnd.choice(["nastyone", "foulness", "nastytwo"]))
        docs.append((i, " ".join(words), "en", int(toxic)))
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, label int")
    model = tox.learn(df, df.select("doc_id", F.col("label").alias("toxic")), settings=QUICK)
    got = tox.with_toxicity(df, model).select("label", "predicted").collect()
    assert model.constant is None and sum(r["label"] == r["predicted"] for r in got) > 0.97 * len(got)


def test_windows_hold_the_telling_words():
    s = tox.Settings(train_words=100, around=4)
    odds = np.zeros(s.buckets, np.float32)
    odds[tox.word_buckets("bad", s.buckets)] = 3
    words = ["w"] * 500 + ["bad"] + ["w"] * 500 + ["bad", "bad"]
    taken = tox.telling_words(words, odds, s)
    assert taken.count("bad") == 3 and len(taken) <= 100 and tox.telling_words(words[:100], odds, s) == words[:100]


def test_one_row_of_an_id_is_drawn_and_ids_without_text_are_replaced(spark):
    given = sentences(300)
    docs = [(k, t, lang) for k, t, lang, _ in given] * 3 + [(k + 1000, None, "en") for k in range(2000)]
    labels = [(k, y) for k, _, _, y in given] + [(k + 1000, k % 2) for k in range(2000)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    known = spark.createDataFrame(labels, "doc_id long, toxic int")
    few = tox.Settings(epochs=1, buckets=1 << 10, train_rows=100)
    model, same = tox.learn(df, known, settings=few), tox.learn(df.dropDuplicates(), known.where("doc_id < 1000"), settings=few)
    assert np.allclose(model.network.table, same.network.table) and model.constant is None


def test_held_out_accuracy_on_the_whole_table(spark):
    """Rows that no label was learned from, scored by the query; labels are the table's."""
    folder = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", F.col("toxic").alias("label"))
    scored = queries.op1_toxicity(spark, folder).where("held_out")
    got = scored.select("doc_id", "score", "predicted").join(labels, "doc_id").toPandas()
    hit, said = got["label"] == 1, got["predicted"] == 1
    assert len(got) > 500 and hit.sum() > 20
    precision, recall = (hit & said).sum() / said.sum(), (hit & said).sum() / hit.sum()
    order = got["score"].rank()
    auc = (order[hit].sum() - hit.sum() * (hit.sum() + 1) / 2) / (hit.sum() * (~hit).sum())
    assert precision > 0.9 and recall > 0.85 and auc > 0.97


def test_best_cut_prefers_the_middle_of_the_gap():
    assert tox.best_cut(np.array([3.0, 2.0, -1.0, -2.0]), np.array([1, 1, 0, 0]), np.ones(4)) == 0.5


def test_every_labelled_row_teaches(spark):
    """Forty toxic words, each in a few rows, and blocks of 60 rows: a sample of 60 rows misses many of them."""
    rnd = random.Random(11)
    plain = [f"w{i}" for i in range(300)]
    bad = ["".join(rnd.choices("abcdefghijklmnop", k=9)) for _ in range(40)]
    docs = []
    for i in range(1600):
        words, toxic = rnd.choices(plain, k=rnd.randint(5, 40)), int(i % 4 == 0)
        if toxic:
            words.insert(rnd.randrange(len(words)), bad[i // 4 % len(bad)])
        docs.append((i, " ".join(words), "en", toxic))
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, label int")
    given = df.select("doc_id", F.col("label").alias("toxic"))
    model = tox.learn(df, given, settings=tox.Settings(epochs=4, buckets=1 << 14, train_rows=60))
    p = tox.Scorer(model.network)([f"w1 w2 w3 {word} w4" for word in bad] + [f"w{i} w{i + 1} w{i + 2}" for i in range(40)])
    assert (p[:40] >= 0.5).mean() > 0.9 and (p[40:] < 0.5).mean() > 0.9


def test_blocks_are_averaged_by_their_texts(spark):
    """One pass over two blocks by Spark equals each block descended alone and the weighted mean of what changed."""
    s = tox.Settings(buckets=1 << 8, dim=4, filters=2)
    odds = np.linspace(-1, 1, s.buckets).astype(np.float32)
    given = [(0, int(k % 3 == 0), f"a{k} b{k % 5} c") for k in range(70)] + [(1, k % 2, f"d{k} b{k % 7}") for k in range(40)]
    df = spark.createDataFrame(given, "block int, toxic int, text string").coalesce(1)
    got = tox.Training(tox.train(df, odds, s, 1))
    start, sums, weights = tox.Training(tox.first_network(odds, s)).values(), 0, 0
    for block in (0, 1):
        alone, own = tox.Training(tox.first_network(odds, s)), [r for r in given if r[0] == block]
        for at in range(0, len(own), s.batch):
            part = own[at : at + s.batch]
            alone.batch([tox.words_of(t) for _, _, t in part], np.array([y for _, y, _ in part], np.float32), tox.Numbered(s.buckets))
        change = alone.values() - start
        touched = np.abs(change).sum(1) > 0
        sums, weights = sums + len(own) * change, weights + len(own) * touched
    want = start + sums / np.maximum(weights, 1)[:, None]
    assert np.allclose(got.values()[:, : s.dim], want[:, : s.dim], atol=1e-5) and np.abs(want - start).max() > 0.01


def test_cuts_of_bins_are_those_of_rows():
    rng = np.random.default_rng(4)
    z = np.round(rng.normal(0, 2, 4_000), 3)
    toxic = (z + rng.normal(0, 1, len(z)) > 1).astype(int)
    f1 = lambda cut: 2 * (toxic & (z >= cut)).sum() / ((z >= cut).sum() + toxic.sum())
    best = max(f1(cut) for cut in np.unique(z))
    assert f1(tox.best_cut(z, toxic, np.ones(len(z)))) == best
    own, where = np.unique(np.floor(z * tox.BINS), return_inverse=True)
    low, high = (np.array([f(z[where == k]) for k in range(len(own))]) for f in (min, max))
    cut = tox.best_bin(low, high, np.bincount(where, toxic), np.bincount(where, 1 - toxic))
    assert f1(cut) > best - 1e-3
