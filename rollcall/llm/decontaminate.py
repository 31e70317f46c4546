"""Benchmark decontamination: rare n-gram seeds join passages to test items, Smith-Waterman alignment scores them.

Seeds are the word n-grams of the benchmark that are rare in the corpus but for copies of their item. So an n-gram is
counted by the texts in which it stands alone: without another n-gram of the same item in the item's order near it. It is
a seed if these are no more than `spread` times the item's first quartile of n-grams (at least `least_rare`), or no more
than half of the texts that hold it. An n-gram that is common anywhere is no seed, and an item that leaked a thousand
times keeps its seeds, be the copies whole or all edited or cut in the same way.

Pass 1 counts the benchmark's n-grams in all texts, in all and alone. Pass 2 finds the seeds in every whole text, cuts passages around
them, and joins passages to items by seed. A passage with `least_seeds` distinct seeds of an item (or all of a shorter
item's) is aligned with it: matching words +2, others and gaps -1, local, so that edited and paraphrased copies score
as well. The score is the alignment's, divided by that of the item against itself.

Words are runs of letters; in scripts that are written without spaces every character is a word. Items go in classes by
their number of words, each with its own bit map, and a passage reaches as far as the longest item of its class, so that
one long item doesn't make all passages long. An item of fewer than n words is a single n-gram, as long as it is; it is a
seed unless it is a common phrase, held by more than one text in a thousand (and by more than `least_rare`).

Texts meet the benchmark through a bit map of n-gram hashes whose size is set by the benchmark and never above
`max_bits`; what passes it joins on the hash itself.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from rollcall.llm.common import (
    bit_plane,
    chunks,
    col,
    free_name,
    hash_runs,
    in_plane,
    is_small,
    keep_table,
    mix,
    prepare,
    text_of,
)

MATCH, MISS = 2, -1
#: N-grams of an item are neighbours up to so many words apart, and in a text up to twice as many.
NEAR = 64
#: What sets the words of an n-gram apart by their places.
_ADDED = mix(np.arange(1, 65, dtype=np.uint64))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IN_WORD = np.zeros(256, bool)
_IN_WORD[[*range(48, 58), *range(65, 91), 95, *range(97, 123), *range(128, 256)]] = True


def _alone(low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of UTF-8 bytes: which are the first of a character that is a word by itself (Thai, Lao, Burmese, Khmer, kana and Han),
    and which belong to East Asian spaces and punctuation."""
    first = np.flatnonzero(low >= 0xE0)
    first = first[first + 2 < len(low)]
    lead, then = low[first], low[first + 1]
    word = (lead >= 0xE4) & (lead <= 0xE9)
    word |= (lead == 0xE3) & (((then >= 0x81) & (then <= 0x83)) | (then >= 0x90))
    word |= (lead == 0xE0) & (then >= 0xB8) & (then <= 0xBB)
    word |= (lead == 0xE1) & (((then >= 0x80) & (then <= 0x82)) | (then == 0x9E) | (then == 0x9F))
    word |= (lead == 0xF0) & (then >= 0xA0) & (then <= 0xB3)
    last = low[first + 2]
    sign = (lead == 0xE3) & (then == 0x80)
    sign |= (lead == 0xEF) & (then == 0xBC) & (((last >= 0x81) & (last <= 0x8F)) | ((last >= 0x9A) & (last <= 0xA0)))
    return first[word], first[sign]


class Words:
    """The words of some texts, cut and hashed in bytes: runs of ASCII letters, digits and underscores and of whatever is not
    ASCII, in lower case (A-Z and the capitals from U+00C0 to U+00DE); single characters of scripts without spaces."""

    def __init__(self, texts: list[str]) -> None:
        raw = [t.encode() for t in texts]
        self.bytes = _LOWER[np.frombuffer(b"\n".join(raw), np.uint8)]
        after = np.flatnonzero(self.bytes[:-1] == 0xC3) + 1
        capital = after[(self.bytes[after] >= 0x80) & (self.bytes[after] <= 0x9E) & (self.bytes[after] != 0x97)]
        self.bytes[capital] += 0x20
        inside = _IN_WORD[self.bytes]
        alone, signs = _alone(self.bytes)
        for k in range(3):
            inside[signs + k] = False
        edge = np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8))
        begins, ends = edge == 1, edge == -1
        if len(alone):
            stops = alone + 3 + (self.bytes[alone] >= 0xF0)
            begins[alone] = ends[stops] = True
            begins[stops[inside[np.minimum(stops, len(inside) - 1)] & (stops < len(inside))]] = True
            ends[alone[(alone > 0) & inside[alone - 1]]] = True
        self.begins, self.ends = np.flatnonzero(begins), np.flatnonzero(ends)
        self.hashes = hash_runs(self.bytes, inside, self.begins, self.ends)
        #: The first word of each text, and the number of all words.
        self.first = np.searchsorted(self.begins, np.cumsum([0, *(len(r) + 1 for r in raw)]))

    def __getitem__(self, words: slice) -> list[str]:
        return [self.bytes[a:b].tobytes().decode() for a, b in zip(self.begins[words], self.ends[words], strict=True)]


def words_of(text: str) -> list[str]:
    return Words([text])[:]


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """The hash of each n-gram of words."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64)
    total = np.zeros(len(hashes) - n + 1, np.uint64)
    for j in range(n):
        total += mix(hashes[j : len(hashes) - n + 1 + j] + _ADDED[j])
    return mix(total)


def alignment(passage: list[str], item: list[str]) -> tuple[int, int]:
    """The best local alignment's score, and where in the passage it ends (exclusive). A row a word of the item; gaps in
    the passage are resolved for a whole row by a running maximum."""
    codes: dict[str, int] = {}
    a = np.fromiter((codes.setdefault(w, len(codes)) for w in passage), np.int64, len(passage))
    steps = np.arange(len(a) + 1) * -MISS
    row = np.zeros(len(a) + 1, np.int64)
    best, end = 0, 0
    for w in item:
        turn = np.maximum(row + MISS, 0)
        np.maximum(turn[1:], row[:-1] + np.where(a == codes.get(w, -1), MATCH, MISS), out=turn[1:])
        row = np.maximum.accumulate(turn + steps) - steps
        k = int(row.argmax())
        if row[k] > best:
            best, end = int(row[k]), k
    return best, end


class Hits:
    """The n-grams of some texts that a bit map has: the words, the position of each hit among them, its text, its hash."""

    def __init__(self, words: Words, hashed: np.ndarray, plane: np.ndarray, n: int) -> None:
        self.words = words
        mask = np.uint64(len(plane) * 32 - 1)
        at = np.flatnonzero(in_plane(plane, (hashed & mask).astype(np.int64)))
        text = np.searchsorted(self.words.first, at, side="right") - 1
        whole = at + n <= self.words.first[text + 1]  # an n-gram ends within its text
        self.at, self.text = at[whole], text[whole]
        self.hashes = hashed[self.at].view(np.int64)


def class_of(size: int, n: int) -> int:
    """The class of an item of so many words: their number if it is less than n; from there on a class for each power of
    four."""
    return size if size < n else n + (size.bit_length() + 1) // 2


def item_grams(benchmark: DataFrame, n: int) -> DataFrame:
    """(item, class, size, gram), distinct: the n-grams of each item; that of all its words where it has fewer."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, text in zip(batch.column("item").to_pylist(), batch.column("text").to_pylist(), strict=True):
                hashes = Words([text]).hashes
                size = len(hashes)
                if size:
                    found = np.unique(grams(hashes, min(n, size))).view(np.int64)
                    same = [np.full(len(found), x) for x in (item, class_of(size, n), size)]
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in (*same, found)], ["item", "class", "size", "gram"])

    return benchmark.mapInArrow(run, "item long, class long, size long, gram long")


def pair_hashes(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return mix(mix(first) + second)


def item_pairs(benchmark: DataFrame, n: int) -> DataFrame:
    """(gram): a hash of each pair of n-grams that an item holds one after the other, up to NEAR words apart."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for text in batch["text"]:
                held = grams(Words([text]).hashes, n)
                for first in range(0, len(held), 1 << 12):  # so that a long item's pairs come in parts
                    part = held[first : first + (1 << 12) + NEAR]
                    pairs = [pair_hashes(part[:-j], part[j:])[: 1 << 12] for j in range(1, min(NEAR + 1, len(part)))]
                    if pairs:
                        yield pd.DataFrame({"gram": np.unique(np.concatenate(pairs)).view(np.int64)})

    return benchmark.select("text").mapInPandas(run, "gram long").distinct()


def in_company(hits: Hits, pairs: np.ndarray) -> np.ndarray:
    """For each hit, whether it makes a pair of an item with another hit near it in the text."""
    paired = np.zeros(len(hits.at), bool)
    mask, hashed = np.uint64(len(pairs) * 32 - 1), hits.hashes.view(np.uint64)
    for j in range(1, min(2 * NEAR, len(paired) - 1) + 1):
        close = (hits.at[j:] - hits.at[:-j] <= 2 * NEAR) & (hits.text[j:] == hits.text[:-j])
        if not close.any():
            break
        i = np.flatnonzero(close & ~(paired[j:] & paired[:-j]) & (hits.hashes[j:] != hits.hashes[:-j]))
        i = i[in_plane(pairs, (pair_hashes(hashed[i], hashed[i + j]) & mask).astype(np.int64))]
        paired[i] = paired[i + j] = True
    return paired


def gram_plane(found: DataFrame, max_bits: int) -> np.ndarray:
    """The bit map of a table's grams: 32 bits a gram, within the bound."""
    bits = min(max_bits, 1 << max(12, (32 * found.count()).bit_length()))
    return bit_plane(found.select((F.col("gram").bitwiseAND(F.lit(bits - 1))).alias("cell")), bits)


def gram_counts(docs: DataFrame, planes: dict[int, np.ndarray], pairs: np.ndarray, n: int) -> DataFrame:
    """Pass 1: (gram, n, alone), how many texts hold each n-gram that the bit maps have (one for each number of words), and
    in how many it never stands with another one of its item. What the map of pairs takes for a pair by mistake makes
    seeds, never loses any."""
    sent = docs.sparkSession.sparkContext.broadcast((planes, pairs))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        planes, pairs = sent.value
        for batch in batches:
            held, alone = [np.zeros(0, np.int64)], [np.zeros(0, bool)]
            for part in chunks(batch["text"], len, 1 << 18):
                words = Words(part)
                for size, plane in planes.items():
                    hits = Hits(words, grams(words.hashes, size), plane, size)
                    paired = in_company(hits, pairs) if size == n else np.zeros(len(hits.at), bool)
                    order = np.lexsort((~paired, hits.hashes, hits.text))  # of a text's equal ones, one in company first
                    text, gram = hits.text[order], hits.hashes[order]
                    again = np.zeros(len(order), bool)
                    again[1:] = (text[1:] == text[:-1]) & (gram[1:] == gram[:-1])
                    held.append(gram[~again])
                    alone.append(~paired[order][~again])
            found, which, times = np.unique(np.concatenate(held), return_inverse=True, return_counts=True)
            single = np.bincount(which, np.concatenate(alone), len(found)).astype(np.int64)
            yield pd.DataFrame({"gram": found, "n": times, "alone": single})

    counted = docs.select("text").mapInPandas(run, "gram long, n long, alone long")
    return counted.groupBy("gram").agg(F.sum("n").alias("n"), F.sum("alone").alias("alone"))


def rare_seeds(found: DataFrame, counts: DataFrame, spread: int, least_rare: int, n: int, most_short: int) -> DataFrame:
    """(item, class, gram, seeds): the n-grams of each item that are rare by the item's measure, and their number. That of an
    item of fewer than n words is rare if `most_short` texts hold it at the most."""
    counted = found.join(counts, "gram", "left").fillna(0, ["n", "alone"])
    limits = counted.groupBy("item").agg(
        F.greatest(F.lit(least_rare), F.lit(spread) * F.percentile("n", F.lit(0.25))).alias("limit")
    )
    rare = F.when(F.col("class") < n, F.col("n") <= most_short).otherwise(F.expr("alone <= greatest(limit, n / 2)"))
    seeds = counted.join(limits, "item").where(rare).select("item", "class", "gram")
    return seeds.join(seeds.groupBy("item").agg(F.count("*").alias("seeds")), "item")


class Class(NamedTuple):
    """A class of items in pass 2: its number, the words of its n-grams, the bit map of its seeds, the words of its longest
    item, and the seeds that a passage needs at the least."""

    number: int
    n: int
    plane: np.ndarray
    reach: int
    least: int


def classes_of(seeds: DataFrame, sizes: DataFrame, n: int, least_seeds: int, max_bits: int) -> list[Class]:
    """One class for each power of four in the items' numbers of words: a few."""
    least = F.min(F.least("seeds", F.lit(least_seeds))).alias("least")
    rows = seeds.groupBy("class").agg(least).join(sizes, "class").orderBy("class").collect()
    return [
        Class(r["class"], min(n, r["class"]), gram_plane(seeds.where(F.col("class") == r["class"]), max_bits), r["size"], r["least"])
        for r in rows
    ]


def passages(docs: DataFrame, classes: list[Class]) -> DataFrame:
    """Pass 2: (uid, id, class, first, words, grams), the passages around enough seeds of a class that lie within its reach
    of their neighbours; as many words on either side come along."""
    sent = docs.sparkSession.sparkContext.broadcast(classes)
    kind = docs.schema["id"].dataType
    names = ["uid", "id", "class", "first", "words", "grams"]
    schema = f"uid long, id {kind.simpleString()}, class long, first int, words string, grams array<long>"
    types = [f.type for f in to_arrow_schema(StructType.fromDDL(schema))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uid = TaskContext.get().partitionId() << 40
        for batch in batches:
            rows, keys, done = [], batch.column("id").to_pylist(), 0
            for part in chunks(batch.column("text").to_pylist(), len, 1 << 18):
                words, hashed = Words(part), {}
                for c in sent.value:
                    if c.n not in hashed:
                        hashed[c.n] = grams(words.hashes, c.n)
                    hits = Hits(words, hashed[c.n], c.plane, c.n)
                    apart = (np.diff(hits.at) > c.reach) | (np.diff(hits.text) > 0)
                    edges = [0, *(np.flatnonzero(apart) + 1).tolist(), len(hits.at)]
                    for i, j in zip(edges, edges[1:], strict=False):
                        distinct = np.unique(hits.hashes[i:j])
                        if len(distinct) < max(1, c.least):
                            continue
                        text = hits.text[i]
                        begin, end = words.first[text], words.first[text + 1]
                        a, b = max(begin, hits.at[i] - c.reach), min(end, hits.at[j - 1] + c.n + c.reach)
                        rows.append((uid, keys[done + text], c.number, int(a - begin), " ".join(words[a:b]), distinct.tolist()))
                        uid += 1
                done += len(part)
            columns = list(zip(*rows, strict=True)) if rows else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    return docs.mapInArrow(run, schema)


def contaminated(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id",
                 item_text: str = "text", n: int = 3, spread: int = 4, least_rare: int = 10, least_seeds: int = 2,
                 least_score: float = 0.4, max_bits: int = 1 << 26, common: float = 0.001) -> DataFrame:
    """A row for each document and item that it holds a copy of: the key, the item's key, score (0 to 1), seeds (distinct
    ones in the passage), first_word and end_word of the aligned passage's end in the document.

    Null and empty texts hold nothing; items without a word match nothing, and one of fewer than n words nothing if more than
    a share of `common` of all texts (and more than `least_rare`) hold it. Where a document holds an item several times, the
    best passage counts, the first of equals. Rows that repeat a key count as one document, items that repeat a key as one
    item; a null key is a key like any other, of documents and of items. An empty table on either side gives no rows; other
    columns are never looked at. Very long texts are cut into words as a whole, in memory that follows their length; what
    travels of them is their passages.
    """
    prepare(docs.sparkSession)
    texts = docs.select(col(key).alias("id"), text_of(text).alias("text")).where("text <> ''")
    columns = F.monotonically_increasing_id().alias("item"), col(item_key).alias("name"), text_of(item_text).alias("text")
    items = keep_table(benchmark.select(*columns).where("text <> ''"), "items")
    found = keep_table(item_grams(items, n), "item_grams")
    pairs = gram_plane(keep_table(item_pairs(items, n), "item_pairs"), max_bits)
    lengths = found.groupBy(F.least("class", F.lit(n)).alias("words")).count().collect()  # n rows at the most
    planes = {r["words"]: gram_plane(found.where(F.least("class", F.lit(n)) == r["words"]), max_bits) for r in lengths}
    counts = keep_table(gram_counts(texts, planes, pairs, n), "gram_counts")
    most_short = max(least_rare, int(common * docs.count())) if any(size < n for size in planes) else least_rare
    seeds = keep_table(rare_seeds(found, counts, spread, least_rare, n, most_short), "seeds")
    sizes = found.groupBy("class").agg(F.max("size").alias("size"))
    near = keep_table(passages(texts, classes_of(seeds, sizes, n, least_seeds, max_bits)), "passages")
    pairs = (
        near.select("uid", "class", F.explode("grams").alias("gram")).join(seeds, ["class", "gram"])
        .groupBy("uid", "item").agg(F.count("*").alias("shared"), F.max("seeds").alias("seeds"))
        .where(F.col("shared") >= F.least("seeds", F.lit(least_seeds)))
    )

    @F.pandas_udf("score double, stop int")
    def align(passage: pd.Series, item: pd.Series) -> pd.DataFrame:
        rows = []
        for a, b in zip(passage, item, strict=True):
            wanted = words_of(b)
            best, stop = alignment(a.split(" "), wanted)
            rows.append((best / (MATCH * len(wanted)), stop))
        return pd.DataFrame(rows, columns=["score", "stop"])

    aligned = (
        pairs.join(near.select("uid", "id", "first", "words"), "uid")
        .join(items.withColumnRenamed("text", "item_words"), "item")
        .withColumn("found", align("words", "item_words"))
        .where(F.col("found.score") >= least_score)
        .withColumn("item", F.col("name"))
    )
    best = F.max_by(
        F.struct("shared", F.col("first").alias("first_word"), (F.col("first") + F.col("found.stop")).alias("end_word")),
        F.struct("found.score", -F.col("first")),
    )
    out = aligned.groupBy("id", "item").agg(F.max("found.score").alias("score"), best.alias("best"))
    return out.select(
        F.col("id").alias(key),
        F.col("item").alias(item_key),
        F.round("score", 6).alias("score"),
        F.col("best.shared").alias("seeds"),
        "best.first_word",
        "best.end_word",
    )


def without_contaminated(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", broadcast_rows: int = 1_000_000,
                         **how) -> DataFrame:
    """The rows of `docs` that hold no copy of an item; all columns stay. Their keys are broadcast when they are at most
    `broadcast_rows` after counting, else joined. Rows without a key go together: all, if one of them holds a copy."""
    name = free_name(docs, "leak_id")
    ids = keep_table(contaminated(docs, benchmark, key=key, **how).select(col(key).alias(name)).distinct(), "leaks")
    few = is_small(ids, broadcast_rows)
    return docs.join(F.broadcast(ids) if few else ids, col(key).eqNullSafe(col(name)), "left_anti")
