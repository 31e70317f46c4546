"""Alignment of the tokens of two tokenizers, A and B, by the bytes they cover.

Method: pointer jumping. Every token points to its farthest-right overlapping token, of either tokenizer; the successor
array is doubled until it no longer changes, and each token then points to the terminal token of its component. A
component is a group: it ends where an A token and a B token both end.

A text is cut where both tokenizers always cut (between words, where the vocabulary of B proves it), each distinct piece
is encoded and aligned once by a worker and remembered, up to a bound. Two passes: the first keeps each document's links
(pairs of ids) as a table and counts the pairs of the whole corpus; the second adds the counts up by document. The most
frequent pairs, a bounded number, are broadcast; occurrences of all others meet their counts by a join.
"""

from __future__ import annotations

import hashlib
import os
import re
import uuid
from collections.abc import Iterator
from functools import partial
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.llm.common import PLACES, chunks, col, hash_runs, in_worker, keep_table, prepare, ragged, text_of
from rollcall.llm.token_files import HashNumbers

#: Pairs that are broadcast at the most: 13 bytes each.
MOST_HOT = 2_000_000
#: Pieces that a worker remembers.
MOST_PIECES = 600_000
#: Characters that are cut and looked up at once.
WINDOW = 1 << 19


# One pair of token streams ------------------------------------------------------------------------------------------


def groups_of(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The group number of each A token and of each B token, from 0, left to right. Both lists of ends rise strictly and
    stop at the same byte."""
    n_a, n_b = len(a_ends), len(b_ends)
    over_a = np.searchsorted(b_ends, a_ends)  # the B token that holds the last byte of each A token
    over_b = np.searchsorted(a_ends, b_ends)
    own = n_a + np.arange(n_b)
    common = a_ends[over_b] == b_ends if n_b else np.zeros(0, bool)
    successor = np.concatenate([n_a + over_a, np.where(common, own, over_b)])
    while True:
        farther = successor[successor]
        if np.array_equal(farther, successor):
            break
        successor = farther
    number = np.cumsum(common) - 1  # terminal tokens are B tokens that end with an A token
    label = number[successor - n_a]
    return label[:n_a], label[n_a:]


def links_of(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The A token and the B token of each link: pairs whose byte ranges overlap, left to right. Two ranges overlap in
    one stretch between neighbouring ends of either stream, so there is a link for every such end."""
    cuts = np.union1d(a_ends, b_ends)
    return np.searchsorted(a_ends, cuts), np.searchsorted(b_ends, cuts)


# Tokenizers ---------------------------------------------------------------------------------------------------------


def _byte_letters() -> dict[str, int]:
    """Which byte each letter of a byte-level vocabulary stands for: printable Latin-1 letters themselves, all others
    by letters from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {chr(b): b for b in shown}
    for k, b in enumerate(b for b in range(256) if b not in letters.values()):
        letters[chr(0x100 + k)] = b
    return letters


_INNER_SPACE = re.compile("[^▁]▁")
_WORD_STOP = re.compile("[0-9A-Za-zÀ-ÖØ-öø-ÿ][.,]")


class Tokenizers:
    """A byte-level tokenizer (definition in JSON) and a sentencepiece model, with the bytes of every token."""

    def __init__(self, definition: str, model: bytes) -> None:
        import json

        import sentencepiece
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.a = Tokenizer.from_str(definition)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=model)
        letters = _byte_letters()
        size = self.a.get_vocab_size()
        self.a_sizes = np.zeros(size, np.int64)
        self.a_bytes: list[bytes] = [b""] * size
        for token, i in self.a.get_vocab().items():
            self.a_bytes[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
            self.a_sizes[i] = len(self.a_bytes[i])
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)
        ]
        self.b_sizes = np.array([len(x) for x in self.b_bytes], np.int64)
        self.a_text = [str(i) for i in range(size)]
        self.b_text = [str(i) for i in range(len(pieces))]
        plain = [p for i, p in enumerate(pieces) if not self.b.is_byte(i)]
        rules = json.loads(definition)
        split = rules.get("pre_tokenizer") or {}
        if size > 1 << 17 or len(pieces) > 1 << 15:
            raise ValueError("a pair of ids must fit 32 bits: 17 for A, 15 for B")
        #: Whether both always cut before a space or line feed that follows a word. A splits words by its expression; of B
        #: no piece may reach over the place.
        self.by_words = (
            not rules.get("normalizer") and split.get("type") == "ByteLevel" and split.get("use_regex", True)
            and not any(_INNER_SPACE.search(p) or "\n" in p for p in plain)
            and [pieces[i] for i in self.b.encode("\n")] == ["▁", "<0x0A>"]
        )
        #: And before a full stop or comma that follows a letter or digit.
        self.by_stops = self.by_words and not any(map(_WORD_STOP.search, plain))

    def encode(self, pieces: list[str], whole: bool) -> tuple[list[list[int]], list[list[int]]]:
        """Ids by A and by B. Pieces begin with the space that B adds by itself where they are whole texts; others follow a
        line feed, which no other token takes in, so that B adds none."""
        a = [e.ids for e in self.a.encode_batch(pieces, add_special_tokens=False)]
        if whole:
            return a, self.b.encode([p[1:] for p in pieces], num_threads=1)
        return a, [ids[2:] for ids in self.b.encode(["\n" + p for p in pieces], num_threads=1)]


# Cutting ------------------------------------------------------------------------------------------------------------

_ASCII_WORD = np.zeros(256, bool)
_ASCII_WORD[[*range(48, 58), *range(65, 91), *range(97, 123)]] = True
_SOLID = np.zeros(256, bool)
_SOLID[0x21:0x7F] = True
#: First bytes of characters among which there is no white space.
_SOLID_LEADS = np.zeros(256, bool)
_SOLID_LEADS[[*range(0xC3, 0xE1), *range(0xE4, 0xF5)]] = True


def cut_words(raw: np.ndarray, by_stops: bool) -> np.ndarray:
    """Which bytes of a text begin a piece (the first one apart): spaces and line feeds after a character that is no white
    space, and, if asked for, full stops and commas after letters and digits."""
    n = len(raw)
    lead = np.maximum.accumulate(np.where((raw & 0xC0) != 0x80, np.arange(n), 0))
    solid = np.where(raw < 0x80, _SOLID[raw], _SOLID_LEADS[raw[lead]])
    begins = np.zeros(n, bool)
    begins[1:] = solid[:-1] & ((raw[1:] == 32) | (raw[1:] == 10))
    if by_stops:
        latin = np.zeros(n, bool)  # U+00C0 to U+00FF but the signs for multiplying and dividing
        latin[1:] = (raw[:-1] == 0xC3) & (raw[1:] >= 0x80) & (raw[1:] != 0x97) & (raw[1:] != 0xB7)
        begins[1:] |= (_ASCII_WORD[raw] | latin)[:-1] & ((raw[1:] == 46) | (raw[1:] == 44))
    return begins


_BREAK = re.compile("[!-~] ")


def windows(text: str, size: int = WINDOW) -> Iterator[str]:
    """A long text in parts of about `size` characters, cut before a space that follows a printable ASCII character. Where
    there is no such place the part is as long as it takes."""
    at = 0
    while len(text) - at > size:
        found = _BREAK.search(text, at + size)
        if not found:
            break
        yield text[at : found.start() + 1]
        at = found.start() + 1
    yield text[at:]


# Pieces, each aligned once --------------------------------------------------------------------------------------------


class Aligner:
    """Aligns texts piece by piece and remembers pieces under a 64-bit hash of their bytes, up to a bound."""

    def __init__(self, tokenizers: Tokenizers, most: int = MOST_PIECES) -> None:
        self.tokenizers, self.most = tokenizers, most
        self._forget()

    def _forget(self) -> None:
        """By piece: `sizes` holds its A tokens, B tokens and groups, -1 for a piece whose tokens don't give its bytes;
        `links` its links one after another, from `first` on; `groups` its groups as text."""
        self.known = HashNumbers(2 * self.most)
        self.sizes = np.zeros((1 << 14, 3), np.int64)
        self.first, self.n_links = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)
        self.links, self.used = np.zeros(1 << 16, np.uint32), 0
        self.groups: list[bytes] = []

    def _learn(self, keys: np.ndarray, pieces: list[bytes]) -> None:
        t = self.tokenizers
        a_ids, b_ids = t.encode([p.decode() for p in pieces], not t.by_words)
        good = np.array([
            b"".join(map(t.a_bytes.__getitem__, a)) == p == b"".join(map(t.b_bytes.__getitem__, b))
            for a, b, p in zip(a_ids, b_ids, pieces, strict=True)
        ], bool)
        kept = np.flatnonzero(good)
        a_each = np.array([len(a_ids[k]) for k in kept], np.int64)
        b_each = np.array([len(b_ids[k]) for k in kept], np.int64)
        a = np.fromiter((i for k in kept for i in a_ids[k]), np.int64, a_each.sum())
        b = np.fromiter((i for k in kept for i in b_ids[k]), np.int64, b_each.sum())
        # pieces follow each other as one stream: both streams end together at every piece's end
        a_ends, b_ends = np.cumsum(t.a_sizes[a]), np.cumsum(t.b_sizes[b])
        a_group, b_group = groups_of(a_ends, b_ends)
        a_link, b_link = links_of(a_ends, b_ends)
        pairs = (a[a_link] << 15 | b[b_link]).astype(np.uint32)
        a_stop, b_stop = np.cumsum(a_each), np.cumsum(b_each)
        link_stop = np.searchsorted(a_link, a_stop)  # links are in order of their A tokens
        group_stop = a_group[a_stop - 1] + 1 if len(kept) else np.zeros(0, np.int64)
        texts = _group_texts(a, b, a_group, b_group, t)
        start, more = self.known.count, len(keys)
        self.known.add(keys)
        while self.used + len(pairs) > len(self.links):
            self.links = np.concatenate([self.links, np.zeros_like(self.links)])
        while start + more > len(self.first):
            self.first, self.n_links, self.sizes = (
                np.concatenate([x, np.zeros_like(x)]) for x in (self.first, self.n_links, self.sizes)
            )
        self.links[self.used : self.used + len(pairs)] = pairs
        at = start + kept
        self.sizes[start : start + more] = -1
        self.first[start : start + more] = self.n_links[start : start + more] = 0
        group_each, link_each = (np.diff(x, prepend=0) for x in (group_stop, link_stop))
        self.sizes[at] = np.stack([a_each, b_each, group_each], axis=1)
        self.n_links[at], self.first[at] = link_each, self.used + link_stop - link_each
        self.used += len(pairs)
        joined = [b""] * more
        for k, begin, stop in zip(kept.tolist(), (group_stop - group_each).tolist(), group_stop.tolist(), strict=True):
            joined[k] = ";".join(texts[begin:stop]).encode()
        self.groups.extend(joined)

    def codes(self, texts: list[str]) -> tuple[np.ndarray, list[int]]:
        """The number of each piece of all texts, and where each text's pieces stop. Numbers hold until the next call."""
        if self.known.count > self.most or self.used > 64 * self.most:
            self._forget()
        raw = [t.encode() for t in texts]
        low = np.frombuffer(b"".join(raw), np.uint8)
        edges = np.array([0, *accumulate(map(len, raw))])
        cut = cut_words(low, self.tokenizers.by_stops) if self.tokenizers.by_words else np.zeros(len(low), bool)
        cut[edges[:-1]] = True
        begins = np.flatnonzero(cut)
        ends = np.append(begins[1:], len(low))
        hashed = hash_runs(low, np.ones(len(low), bool), begins, ends)
        for k in np.flatnonzero(ends - begins > PLACES).tolist():
            hashed[k] = xxhash.xxh3_64_intdigest(low[begins[k] : ends[k]].tobytes())
        hashed[hashed == 0] = 1  # 0 is no key
        found = self.known.find(hashed)
        unknown = np.flatnonzero(found < 0)
        if len(unknown):
            keys, which = np.unique(hashed[unknown], return_index=True)
            self._learn(keys, [low[begins[k] : ends[k]].tobytes() for k in unknown[which].tolist()])
            found[unknown] = self.known.find(hashed[unknown])
        return found, np.searchsorted(begins, edges[1:]).tolist()


def _group_texts(a: np.ndarray, b: np.ndarray, a_group: np.ndarray, b_group: np.ndarray, t: Tokenizers) -> list[str]:
    """Each group as its A ids, a bar and its B ids."""
    if not len(a):
        return []
    sides = []
    for ids, group, text in ((a.tolist(), a_group, t.a_text), (b.tolist(), b_group, t.b_text)):
        stops = np.flatnonzero(np.append(np.diff(group), 1)) + 1
        shown = list(map(text.__getitem__, ids))
        sides.append([",".join(shown[i:j]) for i, j in zip([0, *stops[:-1].tolist()], stops.tolist(), strict=True)])
    return [f"{x}|{y}" for x, y in zip(*sides, strict=True)]


class Document:
    """What has been gathered of one document, window after window."""

    def __init__(self) -> None:
        self.sizes, self.n_links, self.good = np.zeros(3, np.int64), 0, True
        self.links: list[np.ndarray] = []
        self.sha = hashlib.sha256()

    def add(self, sizes: np.ndarray, links: np.ndarray, groups: list[bytes]) -> None:
        if len(sizes) and sizes.min() < 0:
            self.good = False
        if self.good and len(sizes):
            self.sha.update((b";" if self.n_links else b"") + b";".join(groups))
            self.sizes = self.sizes + sizes.sum(axis=0)
            self.n_links += len(links)
            self.links.append(links)

    def row(self) -> tuple:
        """A tokens, B tokens, groups, links, hash of the groups, packed links."""
        if not self.good or not self.n_links:
            return 0, 0, 0, 0, "", b""
        links = self.links[0] if len(self.links) == 1 else np.concatenate(self.links)
        return *self.sizes.tolist(), self.n_links, self.sha.hexdigest(), pack_links(links)


def pack_links(links: np.ndarray) -> bytes:
    """Links in ascending order, as differences in byte planes, which compress well."""
    steps = np.diff(np.sort(links), prepend=np.uint32(0)).astype("<u4")
    return np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 4).T).tobytes()


def unpack_links(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(packed, np.uint8).reshape(4, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u4").ravel(), dtype=np.uint32)


def align_texts(texts: list[str], aligner: Aligner, window: int = WINDOW) -> Iterator[tuple]:
    """A row of `Document` for each text; the space before it is added here."""
    cut = windows if aligner.tokenizers.by_words else lambda text, size: iter([text])
    parts = ((i, p) for i, text in enumerate(texts) for p in (cut(" " + text, window) if text else [""]))
    at, doc = 0, Document()
    for some in chunks(parts, lambda x: len(x[1]), window):
        codes, stops = aligner.codes([p for _, p in some if p]) if any(p for _, p in some) else (np.zeros(0, np.int64), [])
        sizes, counts = aligner.sizes[codes], aligner.n_links[codes]
        links = aligner.links[ragged(aligner.first[codes], counts)]
        ends = np.concatenate([[0], np.cumsum(counts)])
        groups = list(map(aligner.groups.__getitem__, codes.tolist()))
        begin, stop = 0, iter(stops)
        for i, part in some:
            if i != at:
                yield doc.row()
                at, doc = i, Document()
            if part:
                end = next(stop)
                doc.add(sizes[begin:end], links[ends[begin] : ends[end]], groups[begin:end])
                begin = end
    if texts:
        yield doc.row()


# Over a table -------------------------------------------------------------------------------------------------------


def linked(docs: DataFrame, definition: str, model: bytes, key: str, text: str, most: int) -> DataFrame:
    """Pass 1, kept as a table: a row number, the key, the sizes and the packed links of each document."""
    spark = docs.sparkSession
    prepare(spark)
    sent, token = spark.sparkContext.broadcast((definition, model)), uuid.uuid4().hex
    kind = docs.select(col(key)).schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = in_worker(token, lambda: Aligner(Tokenizers(*sent.value), most))
        for batch in batches:
            rows = list(align_texts(batch.column("text").to_pylist(), aligner))
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 6
            types = [pa.int64()] * 4 + [pa.string(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("id"), *map(pa.array, columns, types)],
                ["row", "id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "links"],
            )

    schema = f"row long, id {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, links binary"
    numbered = docs.select(F.monotonically_increasing_id().alias("row"), col(key).alias("id"), text_of(text).alias("text"))
    return keep_table(numbered.mapInArrow(run, schema), "aligned")


def pair_counts(found: DataFrame, most_held: int = 2_000_000) -> DataFrame:
    """pair (A id and B id in one number), n: links of the whole corpus, best: whether n is the highest of its B id. A task
    adds up what it reads and holds `most_held` pairs at the most before it hands them on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def joined() -> tuple[np.ndarray, np.ndarray]:
            pairs, times = (np.concatenate(x) for x in zip(*held, strict=True))
            order = np.argsort(pairs, kind="stable")
            pairs, times = pairs[order], times[order]
            new = np.flatnonzero(np.diff(pairs, prepend=np.uint32(0xFFFFFFFF)))
            return pairs[new], np.add.reduceat(times, new)

        def out() -> pa.RecordBatch:
            pairs, times = joined()
            return pa.RecordBatch.from_arrays([pa.array(pairs.astype(np.int64)), pa.array(times)], ["pair", "n"])

        for batch in batches:
            some = [unpack_links(x) for x in batch.column("links").to_pylist()]
            if some:
                held.append(np.unique(np.concatenate(some), return_counts=True))
            if sum(len(p) for p, _ in held) > most_held:
                held[:] = [joined()]
                if len(held[0][0]) > most_held // 2:
                    yield out()
                    held.clear()
        if sum(len(p) for p, _ in held):
            yield out()

    full = found.where("n_links > 0").select("links")
    counts = full.mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    counts = keep_table(counts.withColumn("b", F.col("pair").bitwiseAND((1 << 15) - 1)), "pairs")
    highest = counts.groupBy("b").agg(F.max("n").alias("highest"))  # a row for each token of B at the most
    return counts.join(F.broadcast(highest), "b").select("pair", "n", (F.col("n") == F.col("highest")).alias("best"))


def _step(n: Column) -> Column:
    """Counts in steps of a sixteenth of an octave: less than 1,024 of them."""
    return F.floor(F.log2(n) * 16).cast("int")


def hot_pairs(pairs: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int | None]:
    """The most frequent pairs, `most` of them or fewer, as sorted arrays (pair, n, best), and the lowest step of counts that
    is among them; None if that is every pair."""
    steps = sorted(map(tuple, pairs.groupBy(_step(F.col("n"))).count().collect()), reverse=True)
    total, least = 0, None
    for step, count in steps:
        if total + count > most:
            break
        total, least = total + count, step
    every = not steps or least == steps[-1][0]
    some = pairs if every else pairs.where(_step(F.col("n")) >= least) if least is not None else pairs.where("false")
    got = some.toPandas().sort_values("pair")
    arrays = got["pair"].to_numpy(np.uint32), got["n"].to_numpy(np.int64), got["best"].to_numpy(bool)
    return *arrays, None if every else 1 << 30 if least is None else least


def aligned(docs: DataFrame, definition: str, model: bytes, key: str = "doc_id", text: str = "text",
            most_hot: int = MOST_HOT, most_pieces: int = MOST_PIECES) -> DataFrame:
    """One row a document: key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    Null and empty texts, and texts that either tokenizer doesn't give back, have zeros and an empty hash. Repeated rows are
    rows of their own, each of which counts; null keys are kept; an empty table gives no rows; other columns are never
    looked at. A very long text is cut between words, and what a task holds of it is its links, four bytes each; a text
    without a space or line feed is encoded in one go."""
    spark = docs.sparkSession
    found = linked(docs, definition, model, key, text, most_pieces)
    pairs = keep_table(pair_counts(found), "pair_counts")
    *hot, least = hot_pairs(pairs, most_hot)
    sent = spark.sparkContext.broadcast(tuple(hot))
    names = ["row", "id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    kinds = {f.name: f.dataType.simpleString() for f in found.schema.fields}
    schema = ", ".join(f"{n} {kinds[n]}" for n in names) + ", n_best long, count_sum long, rest binary"
    second = found.mapInArrow(partial(_add_up, sent, names), schema)
    columns = [F.col("id").alias(key), "n_a", "n_b", "n_groups", "n_links"]
    if least is None:
        return second.select(*columns, "n_best", "count_sum", "groups_sha256")
    second = keep_table(second, "aligned_hot")
    rest = second.where(F.octet_length("rest") > 0).select("row", "rest").mapInArrow(_rest_rows, "row long, pair long, times long")
    cold = pairs.where(_step(F.col("n")) < least)
    sums = rest.join(cold, "pair").groupBy("row").agg(
        F.sum(F.col("times") * F.col("n")).alias("more"), F.sum(F.when(F.col("best"), F.col("times"))).alias("more_best")
    )
    total = second.join(sums, "row", "left")

    def plus(name: str, more: str) -> Column:
        return (F.col(name) + F.coalesce(more, F.lit(0))).cast("long").alias(name)

    return total.select(*columns, plus("n_best", "more_best"), plus("count_sum", "more"), "groups_sha256")


def _add_up(sent, names: list[str], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pass 2: counts of the broadcast pairs by document; the occurrences of all others stay in `rest`."""
    pairs, counts, best = sent.value
    for batch in batches:
        n_best, sums, rest = [], [], []
        for packed in batch.column("links").to_pylist():
            links = unpack_links(packed)
            at = np.minimum(np.searchsorted(pairs, links), max(0, len(pairs) - 1))
            hit = pairs[at] == links if len(pairs) else np.zeros(len(links), bool)
            n_best.append(int(np.count_nonzero(best[at[hit]])))
            sums.append(int(counts[at[hit]].sum()))
            rest.append(b"" if hit.all() else pack_links(links[~hit]))
        arrays = [pa.array(n_best, pa.int64()), pa.array(sums, pa.int64()), pa.array(rest, pa.binary())]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(n) for n in names), *arrays], [*names, "n_best", "count_sum", "rest"]
        )


def _rest_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row, packed in zip(batch.column("row").to_pylist(), batch.column("rest").to_pylist(), strict=True):
            pairs, times = np.unique(unpack_links(packed), return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(pairs), row)), pa.array(pairs.astype(np.int64)), pa.array(times)], ["row", "pair", "times"]
            )
