"""Approximate nearest neighbours by multi-index hashing.

A rotation is learned on a bounded sample (principal directions, then iterative quantization), and the signs of the
rotated vectors are their binary codes. A code is split into substrings, each of which is indexed. By the pigeonhole
principle, a code within Hamming radius r = a * parts + b of a query's code has a substring among the first b + 1 within a
of the query's, or one of the others within a - 1. Probing the substring tables with all such values retrieves every code
within r; those codes are reranked by the distance of the vectors themselves.

The radius is the query's own: the sample gives a bound of its k-th distance and, from pairs of sampled vectors, the
radius that holds all but a small share of the neighbours at that distance. The bound falls while a shard is probed.

The index is a table of shards, each with its vectors and codes. Queries go to the shards in blocks of a fixed size; a shard
answers with its k best at the most, none much beyond the bound, and the answers are merged. A query that has fewer than k
then asks again with the largest radius, which compares it with every row.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollcall.llm.common import col, keep_table, prepare, ragged

#: Vectors that the rotation and the radii are learned on, at the most.
SAMPLE = 20_000
BITS, PARTS = 64, 4
SHARD_ROWS = 1 << 15
#: Queries that are broadcast at once.
BLOCK_QUERIES = 1 << 13
#: Bytes of vectors (doubles) that the sample, a shard and a block of queries hold at the most each, whatever the dimension.
HELD_BYTES = 1 << 24
#: Share of true neighbours that may lie beyond a radius.
BEYOND = 0.01
#: What a shard answers may lie beyond the bound by this factor: it stands in for what no radius reached.
SLACK = 1.05
SALTS = 64
_WIDTH = BITS // PARTS


# Codes --------------------------------------------------------------------------------------------------------------


class Codes(NamedTuple):
    """A learned code: the mean, a projection to BITS directions, and by steps of distance the radius that holds all but a
    small share of the vectors at that distance."""

    mean: np.ndarray
    directions: np.ndarray
    edges: np.ndarray
    radii: np.ndarray

    def of(self, vectors: np.ndarray) -> np.ndarray:
        """A 64-bit code for each vector."""
        signs = (vectors - self.mean) @ self.directions > 0
        return np.packbits(signs, axis=1, bitorder="little").view("<u8").ravel()

    def radius(self, distance: float) -> int:
        """The radius for neighbours up to a distance: everything beyond the last step."""
        return int(self.radii[np.searchsorted(self.edges, distance)])


def rotation(projected: np.ndarray, rounds: int = 30, seed: int = 7) -> np.ndarray:
    """Iterative quantization: the rotation that brings projected vectors nearest to the corners of a cube."""
    turned = np.linalg.qr(np.random.default_rng(seed).normal(size=(projected.shape[1],) * 2))[0]
    for _ in range(rounds):
        left, _, right = np.linalg.svd(projected.T @ np.sign(projected @ turned))
        turned = left @ right
    return turned


def learn(sample: np.ndarray, k: int, beyond: float = BEYOND, probes: int = 400) -> Codes:
    """Directions from the sample's principal ones, turned anew until there are BITS of them, and the radii by distance."""
    n, dim = sample.shape
    mean = sample.mean(axis=0)
    centred = sample - mean
    _, _, principal = np.linalg.svd(centred.T @ centred)
    turned = []
    for seed in range(-(-BITS // dim)):
        base = principal[: min(dim, BITS)].T
        turned.append(base @ rotation(centred @ base, seed=seed))
    codes = Codes(mean, np.concatenate(turned, axis=1)[:, :BITS], np.zeros(0), np.zeros(1))
    # neighbours of some sampled vectors, at several ranks: how far their codes lie, by their distance
    signs = codes.of(sample)
    distances, apart = [], []
    for i in np.linspace(0, n - 1, min(n, probes)).astype(int).tolist():
        near = np.sqrt(((sample - sample[i]) ** 2).sum(axis=1))
        near[i] = np.inf
        chosen = np.argsort(near)[: max(50, 5 * k)]
        chosen = chosen[np.isfinite(near[chosen])]
        distances.append(near[chosen])
        apart.append(np.bitwise_count(signs[chosen] ^ signs[i]))
    distance, hamming = np.concatenate(distances), np.concatenate(apart)
    order = np.argsort(distance)
    steps = [s for s in np.array_split(order, max(1, min(40, len(order) // 200))) if len(s)]
    edges = np.array([distance[s[-1]] for s in steps])
    radii = [int(np.quantile(hamming[s], 1 - beyond, method="higher")) + 1 for s in steps]
    return codes._replace(edges=edges, radii=np.append(np.maximum.accumulate(radii), BITS) if steps else np.array([BITS]))


# Shards -------------------------------------------------------------------------------------------------------------

#: Values of a substring by the number of bits set.
_SHELLS: list[np.ndarray] = []


def shells() -> list[np.ndarray]:
    if not _SHELLS:
        values = np.arange(1 << _WIDTH, dtype=np.int64)
        ones = np.bitwise_count(values)
        _SHELLS.extend(values[ones == a] for a in range(_WIDTH + 1))
    return _SHELLS


class Index:
    """The substring tables of one shard: for each substring, its values that occur, and the vectors of each."""

    def __init__(self, codes: np.ndarray) -> None:
        self.codes = codes
        self.tables = []
        for part in range(PARTS):
            own = self.part_of(codes, part)
            order = np.argsort(own, kind="stable")
            values, first = np.unique(own[order], return_index=True)
            place = np.full(1 << _WIDTH, -1, np.int32)
            place[values] = np.arange(len(values))
            self.tables.append((values, np.append(first, len(order)), order, place))

    @staticmethod
    def part_of(codes: np.ndarray, part: int) -> np.ndarray:
        return (codes >> np.uint64(_WIDTH * part) & np.uint64((1 << _WIDTH) - 1)).astype(np.int64)

    def probe(self, code: np.uint64, part: int, low: int, high: int) -> np.ndarray:
        """The vectors whose substring lies from `low` to `high` bits off the code's. Values to look up are listed, or, where
        fewer occur in the shard, those that occur are compared."""
        values, first, order, place = self.tables[part]
        own = int(self.part_of(np.array([code]), part)[0])
        wanted = shells()[low : high + 1]
        if sum(map(len, wanted)) < len(values):
            hit = place[np.concatenate(wanted) ^ own]
            hit = hit[hit >= 0]
        else:
            off = np.bitwise_count(values ^ own)
            hit = np.flatnonzero((off >= low) & (off <= high))
        return order[ragged(first[hit], first[hit + 1] - first[hit])]

    def within(self, code: np.uint64, beyond: int, radius: int) -> np.ndarray:
        """Every vector whose code lies more than `beyond` (-1: none) and at most `radius` bits off, each once."""
        found = []
        for part in range(PARTS):
            high = min((radius - part) // PARTS, _WIDTH)
            if high >= 0:
                found.append(self.probe(code, part, 0, high))
        some = np.concatenate(found)
        off = np.bitwise_count(self.codes[some] ^ code)
        return np.unique(some[(off > beyond) & (off <= radius)])


def search(index: Index, vectors: np.ndarray, ids: np.ndarray, codes: Codes, query: np.ndarray, code: np.uint64, own, k: int,
           bound: float) -> tuple[np.ndarray, np.ndarray]:
    """The k nearest of a shard, as far as the bound with its slack goes: their places and distances, ties by id. The radius
    grows in three steps, and the bound falls with what is found."""
    at = np.zeros(0, np.int64)
    far = np.zeros(0)
    done = -1
    for share in (1, 2, 3):
        radius = codes.radius(bound) * share // 3
        if radius <= done:
            continue
        new = index.within(code, done, radius)
        done = radius
        new = new[ids[new] != own]
        if len(new):
            near = np.sqrt(((vectors[new].astype(np.float64) - query) ** 2).sum(axis=1))
            keep = near <= bound * SLACK
            at, far = np.concatenate([at, new[keep]]), np.concatenate([far, near[keep]])
            best = np.lexsort((ids[at], far))[:k]
            at, far = at[best], far[best]
            if len(at) == k:
                bound = min(bound, float(far[-1]))
    return at, far


# Over a table -------------------------------------------------------------------------------------------------------


def usable(vectors: DataFrame, key: str, vector: str) -> tuple[DataFrame, int]:
    """id and vector (doubles) of the rows that take part: an id, and a vector without nulls, with finite components that
    aren't all zero, and with as many of them as most rows have; and that number, 0 if there are no rows."""
    rows = vectors.select(col(key).alias("id"), col(vector).cast("array<double>").alias("vector"))
    rows = rows.where(
        F.col("id").isNotNull() & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("vector", lambda x: x != 0)
    )
    sizes = rows.groupBy(F.size("vector").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    dim = sizes["size"] if sizes else 0
    return rows.where(F.size("vector") == dim), dim


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _shards(rows: DataFrame, codes, shard_rows: int) -> DataFrame:
    """The index: a table of one row for each `shard_rows` vectors, with ids, vectors and codes."""
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def out() -> pa.RecordBatch:
            ids = pa.concat_arrays([b.column("id") for b in held])
            vectors = np.concatenate([_matrix(b.column("vector")) for b in held])
            packed = [vectors.tobytes(), codes.value.of(vectors).tobytes()]
            lists = pa.ListArray.from_arrays([0, len(ids)], ids)
            return pa.RecordBatch.from_arrays([lists, *(pa.array([x], pa.binary()) for x in packed)], ["ids", "vectors", "codes"])

        for batch in batches:
            for at in range(0, batch.num_rows, shard_rows):
                held.append(batch.slice(at, shard_rows))
                if sum(b.num_rows for b in held) >= shard_rows:
                    yield out()
                    held.clear()
        if sum(b.num_rows for b in held):
            yield out()

    return keep_table(rows.mapInArrow(run, f"ids array<{kind}>, vectors binary, codes binary"), "vectors")


def _bounds(queries: DataFrame, sample: tuple[np.ndarray, np.ndarray], k: int) -> DataFrame:
    """For each query, a bound of its k-th distance: that among the sampled vectors, with a margin for rounding."""
    sent = queries.sparkSession.sparkContext.broadcast(sample)
    kind = queries.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, vectors = sent.value
        squares = (vectors**2).sum(axis=1)
        for batch in batches:
            own, asked, found = batch.column("id").to_numpy(zero_copy_only=False), _matrix(batch.column("vector")), []
            for at in range(0, len(own), 256):
                some = asked[at : at + 256]
                far = (some**2).sum(axis=1)[:, None] + squares - 2 * some @ vectors.T
                far[own[at : at + 256, None] == ids] = np.inf
                if far.shape[1] > k:
                    far = np.partition(far, k - 1, axis=1)[:, :k]
                kth = far.max(axis=1) if far.shape[1] == k else np.full(len(some), np.inf)
                found.append(np.sqrt(np.maximum(kth, 0)) * (1 + 1e-9) + 1e-6)
            bounds = np.concatenate(found) if found else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("vector"), pa.array(bounds)], ["id", "vector", "bound"])

    return queries.mapInArrow(run, f"id {kind}, vector array<double>, bound double")


def nearest(vectors: DataFrame, asks: Column, k: int = 10, key: str = "vec_id", vector: str = "embedding", sample: int = SAMPLE,
            shard_rows: int = SHARD_ROWS, block_queries: int = BLOCK_QUERIES, seed: int = 11) -> DataFrame:
    """query id, rank, id, score: the k nearest vectors by Euclidean distance to each row that fulfils the condition `asks`
    on the key; all there are, if fewer.

    Rows without an id, and vectors that are null, zero, hold nulls or other than finite numbers, or have another
    dimension than most, take no part. Equal distances go by ascending id. A row with the query's id is never its
    neighbour; repeated rows are neighbours each; of query rows with one id, the least vector asks. An empty table gives no
    rows; other columns are never looked at. Every row is indexed; only the codes are learned from `sample` rows. Of vectors
    of many components sample, shards and blocks hold fewer, so that each stays within HELD_BYTES."""
    spark = vectors.sparkSession
    prepare(spark)
    rows, dim = usable(vectors, key, vector)
    most = max(64, HELD_BYTES // (8 * max(1, dim)))
    sample, shard_rows, block_queries = min(sample, most), min(shard_rows, most), min(block_queries, most)
    kind = rows.schema["id"].dataType.simpleString()
    schema = f"query {kind}, neighbour {kind}, score double"
    n = rows.count()
    some = rows.sample(min(1.0, 1.0 * sample / max(1, n)), seed).limit(sample).toPandas() if n > sample else rows.toPandas()
    if len(some) < 2 and n > 1:
        some = rows.limit(sample).toPandas()
    result = spark.createDataFrame([], f"query {kind}, rank int, neighbour {kind}, score double")
    if n > 1:
        known = some["id"].to_numpy(), np.stack(some["vector"].to_numpy())
        codes = learn(known[1], k)
        shards = _shards(rows, spark.sparkContext.broadcast(codes), shard_rows)
        distinct = rows.where(asks).groupBy("id").agg(F.min("vector").alias("vector"))
        queries = keep_table(_bounds(distinct, known, k), "queries")
        found = keep_table(_merged(_asked(shards, queries, codes, k, block_queries, schema), k), "nearest")
        counts = found.groupBy("query").count()
        short = queries.join(counts, queries["id"] == counts["query"], "left").where(F.coalesce("count", F.lit(0)) < min(k, n - 1))
        short = keep_table(short.select("id", "vector", F.lit(float("inf")).alias("bound")), "short_queries")
        again = _merged(_asked(shards, short, codes, k, block_queries, schema), k)
        result = found.join(short, found["query"] == short["id"], "left_anti").unionByName(again)
    return result.select(F.col("query").alias("query_id"), "rank", F.col("neighbour").alias(key), "score")


def _merged(found: DataFrame, k: int) -> DataFrame:
    """The k best of all shards for each query, ranked; groups of them first, so that no task gets all answers of a query."""
    order = [F.asc("score"), F.asc("neighbour")]
    salted = found.withColumn("salt", F.pmod(F.xxhash64("neighbour"), F.lit(SALTS)))
    for group in (["query", "salt"], ["query"]):
        salted = salted.withColumn("rank", F.row_number().over(Window.partitionBy(*group).orderBy(*order))).where(F.col("rank") <= k)
    return salted.select("query", "rank", "neighbour", "score")


def _asked(shards: DataFrame, queries: DataFrame, codes: Codes, k: int, block_queries: int, schema: str) -> DataFrame:
    """What the shards answer to all queries, in blocks of about `block_queries`. Of several blocks each has its answers
    written, and what was broadcast for it dropped, before the next is collected: one block is held at a time."""
    n = queries.count()
    n_blocks = 1 if n <= block_queries else -(-5 * n // (4 * block_queries))
    parts = []
    for block in range(n_blocks if n else 0):
        some = queries.where(F.pmod(F.xxhash64("id"), F.lit(n_blocks)) == block)
        found, sent = _of_block(shards, some, codes, schema, k)
        if n_blocks > 1:
            found = keep_table(_merged(found, k).drop("rank"), "answers")
            sent.destroy()
        parts.append(found)
    return reduce(DataFrame.unionByName, parts, shards.sparkSession.createDataFrame([], schema))


def _of_block(shards: DataFrame, block: DataFrame, codes: Codes, schema: str, k: int) -> tuple[DataFrame, Broadcast]:
    """The best of each shard for a block of queries, which is collected and broadcast: its size has a bound. And the
    broadcast."""
    asked = block.toArrow()
    own = asked.column("id").combine_chunks()
    points = _matrix(asked.column("vector").combine_chunks()) if len(own) else np.zeros((0, len(codes.mean)))
    queries = own, points, codes.of(points) if len(own) else np.zeros(0, np.uint64), asked.column("bound").to_numpy()
    sent = shards.sparkSession.sparkContext.broadcast((queries, codes))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (own, points, signs, bounds), codes = sent.value
        asking = own.to_numpy(zero_copy_only=False)
        for batch in batches:
            for at in range(batch.num_rows):
                names = batch.column("ids").slice(at, 1).flatten()
                ids = names.to_numpy(zero_copy_only=False)
                vectors = np.frombuffer(batch.column("vectors")[at].as_py(), np.float64).reshape(len(ids), -1)
                index = Index(np.frombuffer(batch.column("codes")[at].as_py(), np.uint64))
                found = [
                    search(index, vectors, ids, codes, points[q], signs[q], asking[q], k, float(bounds[q])) for q in range(len(own))
                ]
                which = np.repeat(np.arange(len(own)), [len(p) for p, _ in found])
                if len(which):
                    places, far = (np.concatenate(x) for x in zip(*found, strict=True))
                    arrays = [own.take(pa.array(which)), names.take(pa.array(places)), pa.array(far)]
                    yield pa.RecordBatch.from_arrays(arrays, ["query", "neighbour", "score"])

    return shards.mapInArrow(run, schema), sent
