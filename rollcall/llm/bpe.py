"""Byte-level BPE encoding and decoding with the ranks of a public vocabulary file.

A text is cut into pre-tokens by the tokenizer's pattern and each is encoded by itself, in two tiers. A minimal perfect
hash (hash and displace: one displacement for each bucket of about four tokens, as many slots as tokens) says at once
whether a whole pre-token is in the vocabulary. Misses are merged byte by byte: a doubly linked list of parts, and a heap
that gives the pair of the lowest rank, leftmost first. A worker remembers the pre-tokens it has met, up to a bound.

Ids travel as little-endian unsigned 32-bit integers in a binary column.
"""

from __future__ import annotations

import base64
import heapq
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from rollcall.llm.common import Learned, chunks, in_worker, mix, mix_one, prepare, ragged

_STEP = np.uint64(0x9E3779B97F4A7C15)


@dataclass
class PerfectHash:
    """Finds the number of a key among n, in n slots. A key that wasn't given finds some number: compare the key."""

    shift: np.ndarray  # for each bucket a displacement, or -1 - slot for a bucket of one key
    slot: np.ndarray  # the number of the key in each slot

    @classmethod
    def of(cls, hashes: np.ndarray) -> PerfectHash:
        """From distinct 64-bit hashes, numbered as they come."""
        n = len(hashes)
        shift, slot = np.zeros(max(1, n // 4), np.int64), np.full(n, -1, np.int64)
        if not n:
            return cls(shift, slot)
        bucket = (hashes % np.uint64(len(shift))).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        counts = np.bincount(bucket, minlength=len(shift))
        ends = np.cumsum(counts)
        free, last = np.ones(n, bool), []
        for b in np.argsort(-counts, kind="stable"):
            keys = order[ends[b] - counts[b] : ends[b]]
            if len(keys) < 2:
                if len(keys):
                    last.append((b, keys[0]))
                continue
            found, tried = None, 0
            while found is None:
                tries = np.arange(tried, tried + 32, dtype=np.uint64)
                at = (mix(hashes[keys] + tries[:, None] * _STEP) % np.uint64(n)).astype(np.int64)
                ok = free[at].all(1)
                for k in np.flatnonzero(ok):
                    if len(set(at[k].tolist())) == len(keys):
                        found = k
                        break
                tried += 32
            shift[b] = tries[found]
            slot[at[found]] = keys
            free[at[found]] = False
        for (b, key), place in zip(last, np.flatnonzero(free), strict=False):
            shift[b], slot[place] = -1 - place, key
        return cls(shift, slot)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        d = self.shift[(hashes % np.uint64(len(self.shift))).astype(np.int64)]
        n = max(1, len(self.slot))
        moved = (mix(hashes + np.maximum(d, 0).astype(np.uint64) * _STEP) % np.uint64(n)).astype(np.int64)
        return self.slot[np.where(d < 0, -1 - d, moved)]


def hash_bytes(words: list[bytes]) -> np.ndarray:
    import xxhash

    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


@dataclass
class Vocabulary:
    """Tokens by id, and the perfect hash that finds them. Ids are ranks."""

    tokens: list[bytes]
    ids: np.ndarray
    hashed: PerfectHash
    pattern: str

    @classmethod
    def read(cls, path: str, pattern: str) -> Vocabulary:
        """From a file of lines "base64 rank". The file lies with the driver; the vocabulary is sent to the tasks."""
        with open(path, "rb") as lines:
            pairs = [(base64.b64decode(a), int(b)) for a, b in map(bytes.split, lines)]
        tokens = [a for a, _ in pairs]
        return cls(tokens, np.array([b for _, b in pairs], np.int64), PerfectHash.of(hash_bytes(tokens)), pattern)


def merge(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token: join the adjacent pair of the lowest rank, the leftmost of equals, until none has a rank."""
    n = len(word)
    end = list(range(1, n + 1))  # of the part that begins here
    before, alive = list(range(-1, n - 1)), [True] * n
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(word[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, stop = heapq.heappop(heap)
        if not alive[i] or end[i] == n or end[end[i]] != stop:
            continue  # one of the two parts has grown or gone meanwhile
        alive[end[i]] = False
        end[i] = stop
        if stop < n:
            before[stop] = i
            if (r := ranks.get(word[i : end[stop]])) is not None:
                heapq.heappush(heap, (r, i, end[stop]))
        if (p := before[i]) >= 0 and (r := ranks.get(word[p:stop])) is not None:
            heapq.heappush(heap, (r, p, stop))
    out, i = [], 0
    while i < n:
        out.append(ranks[word[i : end[i]]])
        i = end[i]
    return out


class Lookup:
    """The first tier: the id of a pre-token that is a token, or -1."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        import xxhash

        self.digest = xxhash.xxh3_64_intdigest
        self.tokens, self.ids = vocabulary.tokens, vocabulary.ids.tolist()
        self.shift, self.slot = vocabulary.hashed.shift.tolist(), vocabulary.hashed.slot.tolist()

    def __call__(self, word: bytes) -> int:
        if not self.slot:
            return -1
        h = self.digest(word)
        d = self.shift[h % len(self.shift)]
        k = self.slot[-1 - d if d < 0 else mix_one(h + d * int(_STEP)) % len(self.slot)]
        return self.ids[k] if self.tokens[k] == word else -1


class Encoder:
    """Encodes in a worker. `known` holds the packed ids of the pre-tokens met so far, `most` at the most."""

    def __init__(self, vocabulary: Vocabulary, most: int = 200_000) -> None:
        import regex

        self.find, self.most = Lookup(vocabulary), most
        self.cut = regex.compile(vocabulary.pattern).findall
        self.ranks = dict(zip(vocabulary.tokens, vocabulary.ids.tolist(), strict=True))
        self.known = Learned(self._learn)

    def _learn(self, word: str) -> bytes:
        raw = word.encode()
        found = self.find(raw)
        return np.array([found] if found >= 0 else merge(raw, self.ranks), "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        if len(self.known) > self.most:
            self.known.clear()
        return b"".join(map(self.known.__getitem__, self.cut(text)))


class Decoder:
    """Decodes packed ids: the letters of all tokens in a row, and where each begins."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        by_id = dict(zip(vocabulary.ids.tolist(), vocabulary.tokens, strict=True))
        ordered = [by_id.get(i, b"") for i in range(max(by_id, default=-1) + 1)]
        self.sizes = np.fromiter(map(len, ordered), np.int64, len(ordered))
        self.begins = np.cumsum(self.sizes) - self.sizes
        self.letters = np.frombuffer(b"".join(ordered), np.uint8)

    def __call__(self, packed: list[bytes]) -> list[bytes]:
        ids = np.frombuffer(b"".join(packed), "<u4").astype(np.int64)
        sizes = self.sizes[ids]
        letters = self.letters[ragged(self.begins[ids], sizes)].tobytes()
        stops = np.concatenate([[0], np.cumsum(sizes)])[np.cumsum([0, *(len(p) // 4 for p in packed)])].tolist()
        return [letters[a:b] for a, b in zip(stops, stops[1:], strict=False)]


def _bytes_udf(spark: SparkSession, vocabulary: Vocabulary, which: str, verify: bool = False):
    prepare(spark)
    sent, token = spark.sparkContext.broadcast(vocabulary), uuid.uuid4().hex

    @F.pandas_udf("binary")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        if which == "encode":
            encoder, decode = in_worker(token, lambda: (Encoder(sent.value), Decoder(sent.value)))
            for batch in batches:
                packed = [encoder.encode(text) for text in batch]
                for text, ids in zip(batch, packed, strict=True) if verify else ():
                    if decode([ids])[0] != text.encode():
                        raise ValueError("ids don't decode to the text they encode")
                yield pd.Series(packed, dtype=object)
        else:
            decode = in_worker(token, lambda: Decoder(sent.value))
            for batch in batches:
                parts = chunks((b"" if x is None else x for x in batch), len, 1 << 18)
                yield pd.Series([out for part in parts for out in decode(part)], dtype=object)

    return run


def encode(spark: SparkSession, vocabulary: Vocabulary, text: Column, verify: bool = False) -> Column:
    """The ids of each whole text, packed; null and empty texts have none. With `verify` the ids are decoded at once, and
    the job fails if they don't give the text's bytes."""
    return _bytes_udf(spark, vocabulary, "encode", verify)(F.coalesce(text.cast("string"), F.lit("")))


def decode(spark: SparkSession, vocabulary: Vocabulary, ids: Column) -> Column:
    """The bytes that packed ids stand for; null gives none."""
    return _bytes_udf(spark, vocabulary, "decode")(ids)


def n_tokens(ids: Column) -> Column:
    return F.floor(F.octet_length(ids) / 4).cast("long")
