"""Ranked lexical search: the best documents for each of a set of items, by integer BM25 scores.

Method: accumulator-limited term-at-a-time. The documents are cut into shards, each with an inverted index of the words
that the items ask for. In a shard, an item's terms are taken rarest first; every document that a term meets gets an
accumulator, until what the remaining terms can add at the most is less than the k-th best partial score. From then on no
accumulator is created, because its document could not come among the k best, and those that exist are updated exactly.
Shards give k documents an item, which are merged; counts of the whole collection weigh the terms in every shard.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rollcall.llm.common import PLACES, chunks, col, hash_runs, keep_table, prepare, text_of

#: A shard is closed when it has so many documents or postings.
SHARD_DOCS, SHARD_POSTINGS = 1 << 16, 1 << 20
#: Items are asked in blocks of so many bytes of text.
BLOCK_BYTES = 16 << 20
#: Bytes of text that are cut into words at once.
WINDOW = 1 << 20
#: Partial results of an item are merged in so many groups first.
SALTS = 64

_IN_TERM = np.ones(256, bool)
_IN_TERM[:128] = False
_IN_TERM[[*range(48, 58), *range(65, 91), *range(97, 123)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def term_hashes(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the terms of UTF-8 bytes, and where each begins: runs of ASCII letters and digits and of all
    characters beyond ASCII; only A-Z is lower-cased."""
    inside = _IN_TERM[raw]
    edge = np.diff(inside.astype(np.int8), prepend=0, append=0)
    begins, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    low = _LOWER[raw]
    hashed = hash_runs(low, inside, begins, ends)
    for k in np.flatnonzero(ends - begins > PLACES).tolist():
        hashed[k] = xxhash.xxh3_64_intdigest(low[begins[k] : ends[k]].tobytes())
    return hashed, begins


def windows(raw: bytes, size: int = WINDOW) -> Iterator[bytes]:
    """A long text in parts of about `size` bytes, cut at a byte that is in no term."""
    at = 0
    while len(raw) - at > size:
        more, stop = np.frombuffer(raw, np.uint8, offset=at + size), None
        for k in range(0, len(more), size):
            outside = ~_IN_TERM[more[k : k + size]]
            if outside.any():
                stop = at + size + k + int(outside.argmax())
                break
        if stop is None:
            break
        yield raw[at:stop]
        at = stop
    yield raw[at:]


# Items --------------------------------------------------------------------------------------------------------------


class Asked(NamedTuple):
    """A block of items: the hashes of their distinct terms, ascending, and for each item its terms' numbers and how often
    each stands in it."""

    hashes: np.ndarray
    terms: list[np.ndarray]
    times: list[np.ndarray]


def asked_of(texts: list[str]) -> Asked:
    found = [np.unique(term_hashes(np.frombuffer(t.encode(), np.uint8))[0], return_counts=True) for t in texts]
    hashes = np.unique(np.concatenate([h for h, _ in found])) if found else np.zeros(0, np.uint64)
    return Asked(hashes, [np.searchsorted(hashes, h) for h, _ in found], [n for _, n in found])


# Index --------------------------------------------------------------------------------------------------------------


class Shard:
    """Documents of one shard as they are read: number of terms, and (term, document, times) of the asked terms."""

    def __init__(self, hashes: np.ndarray) -> None:
        self.hashes = hashes
        self.keys: list[pa.Array] = []
        self.sizes: list[np.ndarray] = []
        self.found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.n_docs = self.n_postings = 0

    def add(self, keys: pa.Array, texts: list[str]) -> None:
        sizes = np.zeros(len(texts), np.int64)
        parts = ((i, part) for i, text in enumerate(texts) for part in windows(text.encode()))
        held = []
        for some in chunks(parts, lambda x: len(x[1]) + 1, WINDOW):
            raw = np.frombuffer(b" ".join(part for _, part in some), np.uint8)
            hashed, begins = term_hashes(raw)
            edges = np.cumsum([0, *(len(part) + 1 for _, part in some)])
            which = np.array([i for i, _ in some])[np.searchsorted(edges, begins, "right") - 1]
            sizes += np.bincount(which, minlength=len(texts))
            at = np.minimum(np.searchsorted(self.hashes, hashed), len(self.hashes) - 1)
            hit = self.hashes[at] == hashed
            held.append(np.unique(at[hit] * len(texts) + which[hit], return_counts=True))
        codes, times = (np.concatenate(x) for x in zip(*held, strict=True))
        codes, place = np.unique(codes, return_inverse=True)  # a long document stands in several parts
        times = np.bincount(place, times, len(codes)).astype(np.int64)
        term, doc = np.divmod(codes, max(1, len(texts)))
        self.found.append((term, doc + self.n_docs, times))
        self.keys.append(keys)
        self.sizes.append(sizes)
        self.n_docs += len(texts)
        self.n_postings += len(codes)

    def row(self) -> pa.RecordBatch:
        """Documents in the order of their keys (none last), postings by term and document."""
        keys, sizes = pa.concat_arrays(self.keys), np.concatenate(self.sizes)
        order = pc.sort_indices(keys, null_placement="at_end").to_numpy()
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        term, doc, times = (np.concatenate(x) for x in zip(*self.found, strict=True))
        doc = place[doc]
        by = np.lexsort((doc, term))
        term, doc, times = term[by], doc[by], times[by]
        terms, first = np.unique(term, return_index=True)
        packed = [sizes[order], terms, np.append(first, len(term)), doc.astype(np.uint32), times.astype(np.uint32)]
        values = pa.ListArray.from_arrays([0, len(keys)], keys.take(pa.array(order)))
        numbers = [int((sizes > 0).sum()), int(sizes.sum())]
        return pa.RecordBatch.from_arrays(
            [values, *(pa.array([n]) for n in numbers), *(pa.array([x.tobytes()], pa.binary()) for x in packed)],
            ["keys", "n_docs", "n_terms", "sizes", "terms", "starts", "docs", "times"],
        )


def index(docs: DataFrame, asked, key: str, text: str, shard_docs: int, shard_postings: int) -> DataFrame:
    """The shards, as a table of one row each. `asked` is the broadcast block of items."""
    kind = docs.select(col(key)).schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = Shard(asked.value.hashes)
        for batch in batches:
            if batch.num_rows:
                shard.add(batch.column("id"), batch.column("text").to_pylist())
            if shard.n_docs >= shard_docs or shard.n_postings >= shard_postings:
                yield shard.row()
                shard = Shard(asked.value.hashes)
        if shard.n_docs:
            yield shard.row()

    schema = f"keys array<{kind}>, n_docs long, n_terms long, sizes binary, terms binary, starts binary, docs binary, times binary"
    rows = docs.select(col(key).alias("id"), text_of(text).alias("text"))
    return keep_table(rows.mapInArrow(run, schema), "shards")


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for terms, starts in zip(batch.column("terms").to_pylist(), batch.column("starts").to_pylist(), strict=True):
            df = np.diff(np.frombuffer(starts, np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(terms, np.int64)), pa.array(df)], ["term", "df"])


class Collection(NamedTuple):
    """Counts of all documents: those with a term, all their terms, and for each asked term the documents that hold it."""

    n_docs: int
    n_terms: int
    df: np.ndarray

    def weights(self) -> np.ndarray:
        top = 2 * self.n_docs + 2
        return np.array([math.floor(1000 * math.log(top / (2 * n + 1))) for n in self.df.tolist()], np.int64)

    def lengths(self, sizes: np.ndarray) -> np.ndarray:
        """The length factor of each document, in hundredths of the mean length's weight."""
        if len(sizes) and 25 * int(sizes.max()) * self.n_docs >= 1 << 63:
            return np.array([75 + 25 * n * self.n_docs // self.n_terms for n in sizes.tolist()], np.int64)
        return 75 + 25 * sizes * self.n_docs // self.n_terms


def collection(shards: DataFrame, n_asked: int) -> Collection:
    sums = shards.agg(F.sum("n_docs"), F.sum("n_terms")).first()
    counts = shards.select("terms", "starts").mapInArrow(_frequencies, "term long, df long")
    found = counts.groupBy("term").agg(F.sum("df").alias("df")).toPandas()  # a row for each asked term at the most
    df = np.zeros(n_asked, np.int64)
    df[found["term"].to_numpy(np.int64)] = found["df"].to_numpy(np.int64)
    return Collection(sums[0] or 0, sums[1] or 0, df)


# Search -------------------------------------------------------------------------------------------------------------


def top_documents(lists: list[tuple[np.ndarray, np.ndarray]], n_docs: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best documents (number, score), equal scores by number. `lists` holds for each term, rarest first, its documents,
    ascending, and what it adds to each."""
    most = [int(gain.max()) if len(gain) else 0 for _, gain in lists]
    rest = np.cumsum([0, *most[::-1]])[::-1]  # what the terms from each one on can add
    scores = np.zeros(n_docs, np.int64)
    live = None
    for i, (docs, gain) in enumerate(lists):
        if live is None:
            held = np.flatnonzero(scores)
            if len(held) > k and rest[i] < np.partition(scores[held], -k)[-k]:
                live = held  # no new document can reach the k-th
        if live is None:
            scores[docs] += gain
        elif len(live) * 8 < len(docs):
            at = np.minimum(np.searchsorted(docs, live), len(docs) - 1)
            hit = docs[at] == live
            scores[live[hit]] += gain[at[hit]]
        else:
            hit = scores[docs] > 0
            scores[docs[hit]] += gain[hit]
    held = np.flatnonzero(scores) if live is None else live
    best = held[np.lexsort((held, -scores[held]))[:k]]
    return best, scores[best]


def search_shard(row: dict, asked: Asked, counts: Collection, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For every item that meets a document of the shard: its number, its best documents' numbers and their scores."""
    sizes, terms, starts = (np.frombuffer(row[c], np.int64) for c in ("sizes", "terms", "starts"))
    docs, times = (np.frombuffer(row[c], np.uint32).astype(np.int64) for c in ("docs", "times"))
    if not len(docs):
        return
    lengths = counts.lengths(sizes)
    worth = 1_000_000_000 * times // (1000 * times + 12 * lengths[docs])
    place = np.full(len(asked.hashes), -1, np.int64)
    place[terms] = np.arange(len(terms))
    weights = counts.weights()
    for item, (wanted, often) in enumerate(zip(asked.terms, asked.times, strict=True)):
        rarest = np.lexsort((wanted, counts.df[wanted]))
        lists = []
        for t, n in zip(wanted[rarest].tolist(), often[rarest].tolist(), strict=True):
            p = place[t]
            if p >= 0:
                a, b = starts[p], starts[p + 1]
                lists.append((docs[a:b], weights[t] * n * worth[a:b]))
        if lists:
            best, scores = top_documents(lists, len(sizes), k)
            if len(best):
                yield item, best, scores


def ranked(docs: DataFrame, items: DataFrame, k: int = 20, key: str = "doc_id", text: str = "text", item_key: str = "item_id",
           item_text: str = "text", shard_docs: int = SHARD_DOCS, shard_postings: int = SHARD_POSTINGS,
           block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """item key, rank, document key, score: the k best documents with a score above 0 for every row of items.

    Null texts have no terms: such documents are found by nothing, such items find nothing. Equal scores go by ascending
    key, null keys last. Repeated documents are ranked each; items of one id are asked each, and so have ranks each. An
    empty table on either side gives no rows. Other columns are never looked at. Very long texts are cut into words in
    parts of a megabyte, at places between words; all of a text counts. Items go to the workers in blocks of
    `block_bytes`, one after another; of each, only its shards and answers stay, as tables."""
    spark = docs.sparkSession
    prepare(spark)
    names = [("item", item_key), ("doc", key)]
    kinds = [t.select(col(c)).schema[0].dataType.simpleString() for t, c in ((items, item_key), (docs, key))]
    wanted = keep_table(
        items.select(F.monotonically_increasing_id().alias("row"), col(item_key).alias("item"), text_of(item_text).alias("text")),
        "items",
    )
    size = wanted.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    n_blocks = max(1, -(-2 * size // block_bytes)) if size > block_bytes else 1
    parts = []
    for block in range(n_blocks):
        some = wanted.where(F.pmod(F.xxhash64("row"), F.lit(n_blocks)) == block).orderBy("row").collect()
        asked = asked_of([r["text"] for r in some])
        if len(asked.hashes):
            found, sent = _of_block(docs, some, asked, k, key, text, kinds, shard_docs, shard_postings)
            if n_blocks > 1:  # of several blocks one is held at a time
                found = keep_table(found, "ranked")
                sent.destroy()
            parts.append(found)
    none = spark.createDataFrame([], f"item {kinds[0]}, rank int, doc {kinds[1]}, score long")
    found = reduce(DataFrame.unionByName, parts, none) if len(parts) != 1 else parts[0]
    return found.select(F.col("item").alias(names[0][1]), "rank", F.col("doc").alias(names[1][1]), "score")


def _of_block(docs: DataFrame, some: list, asked: Asked, k: int, key: str, text: str, kinds: list[str], shard_docs: int,
              shard_postings: int) -> tuple[DataFrame, Broadcast]:
    """The answers to a block of items, and what was broadcast for them."""
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(asked)
    shards = index(docs, sent, key, text, shard_docs, shard_postings)
    counts = collection(shards, len(asked.hashes))
    name_of = {r["row"]: r["item"] for r in some}
    rows = list(name_of)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, row in enumerate(batch.select([c for c in batch.schema.names if c != "keys"]).to_pylist()):
                keys = batch.column("keys").slice(at, 1).flatten()
                found = list(search_shard(row, sent.value, counts, k))
                if found:
                    items = np.repeat([rows[i] for i, _, _ in found], [len(best) for _, best, _ in found])
                    best, scores = (np.concatenate([x[j] for x in found]) for j in (1, 2))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(items, pa.int64()), keys.take(pa.array(best)), pa.array(scores)], ["row", "doc", "score"]
                    )

    found = shards.mapInArrow(run, f"row long, doc {kinds[1]}, score long")
    found = found.withColumn("salt", F.pmod(F.xxhash64("doc", "score"), F.lit(SALTS)))
    order = [F.desc("score"), F.asc_nulls_last("doc")]
    first = found.withColumn("rank", F.row_number().over(Window.partitionBy("row", "salt").orderBy(*order))).where(F.col("rank") <= k)
    last = first.withColumn("rank", F.row_number().over(Window.partitionBy("row").orderBy(*order))).where(F.col("rank") <= k)
    names = spark.createDataFrame([(r, name_of[r]) for r in rows], f"row long, item {kinds[0]}")
    return last.join(F.broadcast(names), "row").select("item", "rank", "doc", "score"), sent
