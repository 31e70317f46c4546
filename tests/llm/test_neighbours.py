import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rollcall.llm import neighbours as nb
from rollcall.llm import queries
from tests.conftest import rows
from tests.llm.conftest import SMALL

BIG = "/root/testdata/sf0.1"


def plain(ids, points, k=10, every=100):
    """query id -> [(distance, id)] by comparing everything."""
    out = {}
    for i in np.flatnonzero(ids % every == 0).tolist():
        far = np.sqrt(((points - points[i]) ** 2).sum(axis=1))
        others = np.flatnonzero(ids != ids[i])
        out[int(ids[i])] = sorted((float(far[j]), int(ids[j])) for j in others)[:k]
    return out


def answers(found):
    out = {}
    for query, rank, neighbour, score in sorted(rows(found, *found.columns)):
        assert rank == len(out.setdefault(query, [])) + 1
        out[query].append((score, neighbour))
    return out


def recall(got, want):
    pairs = [(q, v) for q, best in want.items() for _, v in best]
    return sum(v in {x for _, x in got[q]} for q, v in pairs) / len(pairs)


@settings(max_examples=150, deadline=None)
@given(st.integers(0, 10_000), st.integers(0, nb.BITS), st.integers(-1, 40))
def test_probing_finds_every_code_within_a_radius(seed, radius, done):
    rng = np.random.default_rng(seed)
    centre = rng.integers(0, 1 << 63, dtype=np.uint64)
    flips = rng.random((200, nb.BITS)) < rng.choice([0.05, 0.2, 0.5], (200, 1))
    codes = np.packbits(flips, axis=1, bitorder="little").view("<u8").ravel() ^ centre
    off = np.bitwise_count(codes ^ centre)
    index = nb.Index(codes)
    assert index.within(centre, done, radius).tolist() == np.flatnonzero((off > done) & (off <= radius)).tolist()


def test_listed_values_and_compared_values_agree():
    codes = np.random.default_rng(1).integers(0, 1 << 63, 3000, dtype=np.uint64)
    index, code = nb.Index(codes), codes[0] ^ np.uint64(0b1011)
    for part in range(nb.PARTS):
        own = nb.Index.part_of(codes, part)
        for low, high in ((0, 0), (0, 2), (1, 3), (2, 16)):
            off = np.bitwise_count(own ^ nb.Index.part_of(np.array([code]), part)[0])
            assert set(index.probe(code, part, low, high).tolist()) == set(np.flatnonzero((off >= low) & (off <= high)).tolist())


def test_codes_keep_near_vectors_near():
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(20, 24))
    points = np.repeat(centres, 50, axis=0) + rng.normal(size=(1000, 24)) * 0.05
    codes = nb.learn(points, 10)
    signs = codes.of(points)
    off = np.bitwise_count(signs[:, None] ^ signs)
    same = np.arange(1000)[:, None] // 50 == np.arange(1000) // 50
    assert off[same].mean() < 0.35 * off[~same].mean()
    assert codes.directions.shape == (24, nb.BITS) and codes.radius(0.01) < codes.radius(1e9) == nb.BITS


@pytest.mark.parametrize("folder, least", [(SMALL, 0.9), (BIG, 0.93)])
def test_recall_on_the_whole_table(spark, folder, least):
    table = spark.read.parquet(f"{folder}/embeddings.parquet").toPandas()
    want = plain(table["vec_id"].to_numpy(), np.stack(table["embedding"].to_numpy()).astype(float))
    found = queries.op13_nearest_vectors(spark, folder)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    got = answers(found)
    assert {q: len(x) for q, x in got.items()} == {q: len(x) for q, x in want.items()}
    assert recall(got, want) >= least
    exact = {(q, v): s for q, best in plain(table["vec_id"].to_numpy(), np.stack(table["embedding"].to_numpy()).astype(float), k=10**6).items() for s, v in best}
    assert all(s == pytest.approx(exact[q, v], rel=1e-12) for q, best in got.items() for s, v in best)


def test_small_sample_shards_and_blocks(spark):
    """The sample is a small part, there are many shards and blocks of queries: recall stays."""
    df = spark.read.parquet(f"{BIG}/embeddings.parquet")
    table = df.toPandas()
    want = plain(table["vec_id"].to_numpy(), np.stack(table["embedding"].to_numpy()).astype(float), every=20)
    got = answers(nb.nearest(df.repartition(4), F.col("id") % 20 == 0, sample=400, shard_rows=150, block_queries=30))
    assert recall(got, want) >= 0.9 and all(len(x) == 10 for x in got.values())


def test_memory_follows_no_dimension(spark, monkeypatch):
    """With room for few vectors there are more shards and blocks, and the answers stay."""
    monkeypatch.setattr(nb, "HELD_BYTES", 8 * 200 * 300)
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(12, 200))
    points = centres[np.arange(1200) % 12] + rng.normal(size=(1200, 200)) * 0.2
    df = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)], "vec_id long, embedding array<double>").repartition(2)
    kept, keep = [], nb.keep_table
    monkeypatch.setattr(nb, "keep_table", lambda table, name: kept.append((name, keep(table, name))) or kept[-1][1])
    got = answers(nb.nearest(df, F.col("id") % 50 == 0))
    shards = dict(kept)["vectors"].select(F.size("ids").alias("n")).collect()
    assert max(r["n"] for r in shards) == 300 and sum(r["n"] for r in shards) == 1200
    assert recall(got, plain(np.arange(1200), points, every=50)) >= 0.9 and all(len(x) == 10 for x in got.values())


def test_copies_and_ties(spark):
    """A third of all rows are one vector; ties go to the smaller id."""
    rng = np.random.default_rng(3)
    points = rng.normal(size=(900, 8)).round(2)
    points[::3] = points[0]
    data = [(i, p.tolist()) for i, p in enumerate(points)]
    got = answers(nb.nearest(spark.createDataFrame(data, "vec_id long, embedding array<double>"), F.col("id") % 90 == 0))
    assert [v for _, v in got[0]] == list(range(3, 33, 3)) and {s for s, _ in got[0]} == {0.0}
    assert [v for _, v in got[90]] == [0, 3, 6, 9, 12, 15, 18, 21, 24, 27]


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    data = [
        (0, [1.0, 0.0], "a"), (1, [1.0, 0.1], "b"), (2, None, "c"), (3, [0.0, 0.0], "d"), (4, [1.0, None], "e"), (5, [nan, 1.0], "f"),
        (6, [inf, 1.0], "g"), (7, [], "h"), (8, [1.0, 2.0, 3.0], "i"), (None, [1.0, 0.0], "j"), (1, [1.0, 0.1], "k"), (100, [0.9, 0.0], "l"),
        (100, [5.0, 5.0], "m"), (200, None, "n"),
    ]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>, id string").withColumn("score", F.lit(1)).withColumn("query", F.lit(2))
    got = answers(nb.nearest(df, F.col("id") % 100 == 0))
    assert {q: [v for _, v in best] for q, best in got.items()} == {0: [100, 1, 1, 100], 100: [0, 1, 1]}
    assert got[0][0][0] == pytest.approx(0.1)
    for some in (df.limit(0), df.where("vec_id = 0"), df.where("vec_id = 2")):
        assert rows(nb.nearest(some, F.col("id") % 100 == 0)) == []
    two = df.where("vec_id in (0, 100)").where("id != 'm'")
    assert answers(nb.nearest(two, F.col("id") % 100 == 0)).keys() == {0, 100}
