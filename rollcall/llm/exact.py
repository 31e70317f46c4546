"""Exact duplicates by a two-pass Bloom filter.

Pass 1 puts the hash of every text into a Bloom filter whose cells count to two: every text marks four cells of one word
of 64, and a cell marked by one text only cannot belong to a repeated one. Marks are merged by words, first in each task,
then for each slab of words. Pass 2 tests each text against the cells that were marked twice. A text with four such cells
is possibly repeated; only those rows shuffle, to be grouped by their SHA-256. All others pass straight through.

The filter takes `cells_per_row` cells a row. What is collected and broadcast at once is never more than `max_cells` (2^30
cells are 128 MB and serve 67 million rows): more rows get as many filters as they ask for, each for the hashes of its own
range, and are tested by one range after another. So the share of rows that shuffle needlessly is the same at any size.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.llm.common import col, free_name, is_small, keep_table, prepare, text_of

PROBES = 4
#: Words of 64 cells that are merged and sent as one row, and rows that a task merges at once.
SLAB, CHUNK = 1 << 14, 1 << 16
MAX_CELLS = 1 << 30
#: Parts of the copies of one text.
SALTS = 256
#: Verdicts that are broadcast to documents at the most, if there are several filters.
BROADCAST_ROWS = 1_000_000


@dataclass(frozen=True)
class Filters:
    """How many filters there are, and how many cells (a power of two) each has."""

    number: int
    cells: int

    @staticmethod
    def for_rows(rows: int, cells_per_row: int, max_cells: int) -> Filters:
        wanted = rows * cells_per_row
        return Filters(max(1, -(-wanted // max_cells)), min(max_cells, 1 << max(10, (wanted - 1).bit_length())))

    def range_of(self, sha: Column) -> Column:
        return F.pmod(F.xxhash64(F.lit(2), sha), F.lit(self.number)).cast("int")

    def word_of(self, sha: Column) -> Column:
        return F.xxhash64(F.lit(0), sha).bitwiseAND(F.lit(max(1, self.cells // 64) - 1))

    def marks_of(self, sha: Column) -> Column:
        """The four cells of a hash in its word."""
        drawn, marks = F.xxhash64(F.lit(1), sha), F.lit(0).cast("long")
        for i in range(PROBES):
            place = F.shiftright(drawn, 6 * i).bitwiseAND(F.lit(63)).cast("int")
            marks = marks.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), place))
        return marks


def merge(words: np.ndarray, once: np.ndarray, twice: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Marks by distinct word: the cells marked at all, and those marked twice or more."""
    order = np.argsort(words, kind="stable")
    words, once, twice = words[order], once[order], twice[order]
    starts = np.flatnonzero(np.append(True, words[1:] != words[:-1]))
    bits = np.unpackbits(once.view(np.uint8).reshape(-1, 8), axis=1)
    again = np.packbits(np.add.reduceat(bits, starts, axis=0, dtype=np.int32) > 1, axis=1).view(np.uint64).ravel()
    return words[starts], np.bitwise_or.reduceat(once, starts), np.bitwise_or.reduceat(twice, starts) | again


def repeated_cells(hashes: DataFrame, filters: Filters) -> DataFrame:
    """Pass 1: (range, slab, twice): of each filter, by slabs of words, the cells that two rows or more have marked.
    `hashes` holds a column sha."""
    sha, words = F.col("sha"), max(1, filters.cells // 64)
    marks = hashes.select(
        filters.range_of(sha).alias("range"), filters.word_of(sha).alias("word"), filters.marks_of(sha).alias("once")
    )

    def merged(held: list[pd.DataFrame]) -> pd.DataFrame:
        part = pd.concat(held)
        key, once, twice = merge(
            part["range"].to_numpy(np.int64) * words + part["word"].to_numpy(np.int64),
            part["once"].to_numpy(np.int64).view(np.uint64), np.zeros(len(part), np.uint64),
        )
        numbers, word = np.divmod(key, words)
        return pd.DataFrame({
            "range": numbers.astype(np.int32), "slab": word // SLAB, "word": word,
            "once": once.view(np.int64), "twice": twice.view(np.int64),
        })

    def local(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, rows = [], 0
        for batch in batches:
            held.append(batch)
            rows += len(batch)
            if rows >= CHUNK:
                yield merged(held)
                held, rows = [], 0
        if rows:
            yield merged(held)

    def slabs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        planes: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for name, part in batch.groupby(["range", "slab"]):
                plane = planes.setdefault(name, np.zeros((2, min(SLAB, words)), np.uint64))
                word, once, twice = merge(
                    part["word"].to_numpy(np.int64) % SLAB,
                    part["once"].to_numpy(np.int64).view(np.uint64), part["twice"].to_numpy(np.int64).view(np.uint64),
                )
                plane[1, word] |= twice | (plane[0, word] & once)
                plane[0, word] |= once
        for (number, slab), plane in planes.items():
            yield pd.DataFrame({"range": [number], "slab": [slab], "twice": [plane[1].tobytes()]})

    sent = marks.mapInPandas(local, "range int, slab long, word long, once long, twice long")
    return sent.repartition("range", "slab").mapInPandas(slabs, "range int, slab long, twice binary")


class Tested:
    """Both passes over `hashes` (id, sha): `flagged` has a column maybe, that a hash is possibly repeated. With one filter,
    `condition` says so of any hash."""

    def __init__(self, hashes: DataFrame, cells_per_row: int, max_cells: int) -> None:
        self.filters = Filters.for_rows(hashes.count(), cells_per_row, max_cells)
        self.planes = repeated_cells(hashes, self.filters)
        if self.filters.number == 1:
            self.flagged = hashes.withColumn("maybe", self.condition(F.col("sha")))
            return
        self.planes = keep_table(self.planes, "planes")
        number, parts = self.filters.range_of(F.col("sha")), []
        for k in range(self.filters.number):  # one filter in memory at a time
            plane = self._plane(k)
            part = hashes.where(number == k)
            parts.append(keep_table(part.withColumn("maybe", self._test(plane, F.col("sha"))), f"flagged{k}"))
            plane.unpersist()
        self.flagged = parts[0]
        for part in parts[1:]:
            self.flagged = self.flagged.unionByName(part)

    def condition(self, sha: Column) -> Column:
        if not hasattr(self, "_only"):
            self._only = self._plane(0)
        return self._test(self._only, sha)

    def _plane(self, number: int):
        words = max(1, self.filters.cells // 64)
        plane = np.zeros(words, np.uint64)
        for row in self.planes.where(F.col("range") == number).select("slab", "twice").collect():  # max_cells at the most
            part = np.frombuffer(row["twice"], np.uint64)
            plane[row["slab"] * SLAB : row["slab"] * SLAB + len(part)] = part
        return self.planes.sparkSession.sparkContext.broadcast(plane)

    def _test(self, plane, sha: Column) -> Column:
        @F.pandas_udf("boolean")
        def all_marked(word: pd.Series, marks: pd.Series) -> pd.Series:
            marks = marks.to_numpy(np.int64).view(np.uint64)
            return pd.Series(plane.value[word.to_numpy(np.int64)] & marks == marks)

        return all_marked(self.filters.word_of(sha), self.filters.marks_of(sha))


def _hashes(docs: DataFrame, key: str, text: str) -> DataFrame:
    prepare(docs.sparkSession)
    return keep_table(docs.select(col(key).alias("id"), F.unhex(F.sha2(text_of(text), 256)).alias("sha")), "hashes")


def exact_groups(
    docs: DataFrame, key: str = "doc_id", text: str = "text", cells_per_row: int = 16, max_cells: int = MAX_CELLS
) -> DataFrame:
    """One row a row of `docs`: its key, keep_id (the largest key among equal texts), group_size, kept, text_sha256.

    Texts are equal when identical without any change; null counts as empty. A null key is smaller than any other; where
    a group has none but null keys, keep_id is null and its rows stay. Rows that repeat text and key both get the same
    verdict; `without_copies` keeps one of them. An empty table gives no rows. Other columns are never looked at.
    """
    hashes = _hashes(docs, key, text)
    flagged = Tested(hashes, cells_per_row, max_cells).flagged
    suspects = flagged.where("maybe").select("id", "sha")
    # The copies of one text are dealt to SALTS parts, so that no task holds them all: rows meet the verdict of their part.
    salted = suspects.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)))
    parts = salted.groupBy("sha", "salt").agg(F.max("id").alias("top"), F.count("*").alias("n"))
    groups = parts.groupBy("sha").agg(F.max("top").alias("keep_id"), F.sum("n").alias("group_size"))
    verdicts = parts.select("sha", "salt").join(groups, "sha")
    checked = salted.join(verdicts, ["sha", "salt"]).select("id", "keep_id", "group_size", "sha")
    alone = flagged.where("not maybe").select(
        "id", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), "sha"
    )
    return checked.unionByName(alone).select(
        F.col("id").alias(key),
        "keep_id",
        "group_size",
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def without_copies(
    docs: DataFrame, key: str = "doc_id", text: str = "text", cells_per_row: int = 16, max_cells: int = MAX_CELLS
) -> DataFrame:
    """The rows of `docs`, one for each text: that of the largest key, one of them where it repeats. All columns stay.

    Rows whose text cannot be repeated are not shuffled. The others meet the key that stays by hash and key together, so
    that copies of one text spread over all tasks. Nulls are treated as in `exact_groups`. With several filters no single
    one can test the documents: the verdicts on the suspects are broadcast if they are few after counting, else joined.
    """
    hashes = _hashes(docs, key, text)
    tested = Tested(hashes, cells_per_row, max_cells)
    wanted, sha, maybe = [col(c) for c in docs.columns], free_name(docs, "sha"), free_name(docs, "maybe")
    suspects = tested.flagged.where("maybe").select("id", "sha")
    stays = suspects.groupBy("sha").agg(F.max("id").alias("keep"))
    hashed = docs.withColumn(sha, F.unhex(F.sha2(text_of(text), 256)))
    if tested.filters.number == 1:
        flagged = hashed.withColumn(maybe, tested.condition(col(sha)))
        stay_sha, stay_id = free_name(flagged, "stay_sha"), free_name(flagged, "stay_id")
        kept = stays.select(F.col("sha").alias(stay_sha), F.col("keep").alias(stay_id))
        left = flagged.where(col(maybe)).join(kept, (col(sha) == col(stay_sha)) & col(key).eqNullSafe(col(stay_id)), "inner")
        alone = flagged.where(~col(maybe))
    else:
        stay_sha, stay_id = free_name(hashed, "stay_sha"), free_name(hashed, "stay_id")
        verdicts = suspects.distinct().join(stays, "sha").select(
            F.col("sha").alias(stay_sha), F.col("id").alias(stay_id), F.col("id").eqNullSafe(F.col("keep")).alias(maybe)
        )
        verdicts = keep_table(verdicts, "verdicts")
        few = is_small(verdicts, BROADCAST_ROWS)
        met = (col(sha) == col(stay_sha)) & col(key).eqNullSafe(col(stay_id))
        judged = hashed.join(F.broadcast(verdicts) if few else verdicts, met, "left")
        left, alone = judged.where(col(maybe)), judged.where(col(maybe).isNull())
    return left.dropDuplicates([stay_sha]).select(wanted).unionByName(alone.select(wanted))
