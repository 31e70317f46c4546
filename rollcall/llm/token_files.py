"""Token ids in files of shuffled bit planes.

Ids are taken as one stream in the order of the documents' keys. The stream is range-partitioned, each partition gives
one file, and a file is a run of blocks of a fixed number of ids. A block is transposed: plane k holds bit (or byte) k of
all its ids, and each plane is compressed with zstandard by itself, so planes that are all zero cost a few bytes. The
files are Parquet tables of one row a block; a row has the block's place, its payload and the index of the documents
that begin in it, so one document can be read without its neighbours. Spark's writer commits them: a lost or repeated
task leaves no half file behind.
"""

from __future__ import annotations

import os
import re
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from rollcall.llm.common import PLACES, chunks, col, hash_runs, in_worker, keep_table, prepare, ragged, text_of

BLOCK_IDS = 1 << 16
#: A file holds about so many bytes of ids, unless there would be more than MOST_FILES.
FILE_BYTES, MOST_FILES = 32 << 20, 100_000
#: One row a block. `first` is its place in the part's stream; the arrays list every document that has ids in the block:
#: its key, where it begins in the part's stream, and all its ids' number.
BLOCK_SCHEMA = (
    "part int, block int, first long, n_ids int, payload binary, "
    "doc_ids array<{key}>, doc_starts array<long>, doc_sizes array<long>"
)


# Blocks --------------------------------------------------------------------------------------------------------------


def pack_block(ids: np.ndarray, planes: str = "byte", level: int = 3) -> bytes:
    """A header (number of ids, number of planes, the size of each) and the compressed planes, lowest first."""
    import zstandard

    squeeze = zstandard.ZstdCompressor(level=level).compress
    raw = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4)
    if planes == "bit":
        rows = np.packbits(np.unpackbits(raw, axis=1, bitorder="little").T, axis=1)
    else:
        rows = np.ascontiguousarray(raw.T)
    parts = [squeeze(r.tobytes()) for r in rows]
    return struct.pack(f"<II{len(parts)}I", len(ids), len(parts), *map(len, parts)) + b"".join(parts)


def unpack_block(payload: bytes) -> np.ndarray:
    import zstandard

    n, planes = struct.unpack_from("<II", payload)
    sizes = struct.unpack_from(f"<{planes}I", payload, 8)
    expand, at, rows = zstandard.ZstdDecompressor().decompress, 8 + 4 * planes, []
    for size in sizes:
        rows.append(np.frombuffer(expand(payload[at : at + size]), np.uint8))
        at += size
    if planes == 32:
        bits = np.unpackbits(np.stack(rows), axis=1)[:, :n]
        raw = np.packbits(bits.T, axis=1, bitorder="little")
    else:
        raw = np.stack(rows, axis=1)
    return np.ascontiguousarray(raw).view("<u4").ravel()


def blocks_of(rows: Iterator[tuple], part: int, block_ids: int, planes: str, id_bytes: int = 4) -> Iterator[tuple]:
    """Block rows of one partition's documents (key, packed ids), in order. A document without ids stands in the block where
    it would begin. What is held is two blocks and one document."""
    held, open_docs = [], []
    seen = first = block = 0

    def cut(n: int, last: bool = False) -> tuple:
        nonlocal held, open_docs, first, block
        stream = np.concatenate(held) if held else np.zeros(0, "<u4")
        stop = first + n
        here = [d for d in open_docs if last or d[1] < stop]
        open_docs = [d for d in open_docs if not last and (d[1] >= stop or d[1] + d[2] > stop)]
        row = (part, block, first, n, pack_block(stream[:n], planes), *([d[k] for d in here] for k in range(3)))
        held, first, block = [stream[n:]], stop, block + 1
        return row

    for key, packed in rows:
        ids = np.frombuffer(packed, f"<u{id_bytes}")
        open_docs.append((key, seen, len(ids)))
        held.append(ids)
        seen += len(ids)
        while seen - first >= 2 * block_ids:
            yield cut(block_ids)
    while seen - first > block_ids:
        yield cut(block_ids)
    if open_docs:
        yield cut(seen - first, last=True)


def file_count(n_bytes: int, file_bytes: int = FILE_BYTES, most: int = MOST_FILES) -> int:
    """Files for so many bytes of ids. Beyond `most` files they grow instead of their number."""
    return max(1, min(most, -(-n_bytes // file_bytes)))


def write_token_files(docs: DataFrame, ids: str, key: str, name: str = "tokens", parts: int | None = None,
                      block_ids: int = BLOCK_IDS, planes: str = "byte", id_bytes: int = 4) -> DataFrame:
    """Write packed ids (little-endian, unsigned, of `id_bytes` bytes) in ascending order of the key, null keys first, and
    return the block table as read back. Rows of an equal key go in the order of a hash of their ids, and may fall in
    several files, so that one key's many rows don't meet in one task. No rows give no blocks. The rows are read three
    times: they are counted, sampled for the order, and written."""
    spark = docs.sparkSession
    prepare(spark)
    rows = docs.select(col(key).alias("id"), col(ids).alias("ids"))
    parts = parts or file_count(rows.agg(F.sum(F.octet_length("ids"))).first()[0] or 0)
    kind = rows.schema["id"].dataType
    schema = BLOCK_SCHEMA.format(key=kind.simpleString())
    to_arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        rows = (r for b in batches for r in zip(b.column("id").to_pylist(), b.column("ids").to_pylist(), strict=True))
        for row in blocks_of(rows, part, block_ids, planes, id_bytes):
            yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(row, to_arrow, strict=True)], to_arrow.names)

    numbered = rows.withColumns({"hash": F.xxhash64("ids"), "row": F.monotonically_increasing_id()})
    ordered = numbered.repartitionByRange(parts, "id", "hash", "row").sortWithinPartitions("id", "hash", "row").select("id", "ids")
    return keep_table(ordered.mapInArrow(run, schema), name)


def _bases(blocks: DataFrame) -> DataFrame:
    """Where the stream of each file begins in the stream of all: one row a file, and there are MOST_FILES at the most."""
    sizes = blocks.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return F.broadcast(sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")))


def _pieces(blocks: DataFrame, value: str, of: Callable[[np.ndarray], object], which: str = "all") -> DataFrame:
    """A row for each piece of a document in a block: its place, and what `of` gives for its ids as the column `value`.
    `which` takes the pieces that are a whole document ("whole"), or those that aren't ("cut")."""
    kind = blocks.schema["doc_ids"].dataType.elementType.simpleString()
    schema = f"part int, doc_start long, id {kind}, size long, block int, whole boolean, n long, {value}"
    to_arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                rows, found, stop = [], None, r["first"] + r["n_ids"]
                for key, start, size in zip(r["doc_ids"], r["doc_starts"], r["doc_sizes"], strict=True):
                    whole = start >= r["first"] and start + size <= stop
                    if which == "all" or (which == "whole") == whole:
                        found = unpack_block(r["payload"]) if found is None else found
                        piece = found[max(0, start - r["first"]) : max(0, start + size - r["first"])]
                        rows.append((r["part"], start, key, size, r["block"], whole, len(piece), of(piece)))
                if rows:
                    columns = zip(zip(*rows, strict=True), to_arrow, strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in columns], to_arrow.names)

    return blocks.mapInArrow(run, schema)


def _placed(found: DataFrame, blocks: DataFrame, *columns: str) -> DataFrame:
    start = (F.col("base") + F.col("doc_start")).alias("start")
    return found.join(_bases(blocks), "part").select("id", start, *columns)


_PLACE = ["part", "doc_start", "id", "size"]


def read_token_files(blocks: DataFrame) -> DataFrame:
    """The documents of a block table: id, start (ids of all documents before it) and their packed ids.

    A document within one block comes straight from it; only the pieces of those that cross a block's edge shuffle, and
    meet in one row, as the result asks for."""
    whole = _pieces(blocks, "ids binary", np.ndarray.tobytes, "whole").select("part", "doc_start", "id", "ids")
    joined = (
        _pieces(blocks, "ids binary", np.ndarray.tobytes, "cut").groupBy(*_PLACE)
        .agg(F.array_sort(F.collect_list(F.struct("block", "ids"))).alias("pieces"))
        .select("part", "doc_start", "id", F.aggregate("pieces", F.lit(b""), lambda done, p: F.concat(done, p["ids"])).alias("ids"))
    )
    return _placed(whole.unionByName(joined), blocks, "ids")


def read_sums(blocks: DataFrame) -> DataFrame:
    """The documents of a block table without their ids: id, start, n_ids and the CRC-32 of all ids as packed.

    Every block is read once, and no ids leave the task that reads them. Of a document that crosses a block's edge only the
    checksums of the pieces meet, which give that of the whole."""
    pieces = keep_table(_pieces(blocks, "crc long", lambda ids: zlib.crc32(ids.tobytes())), "piece_sums")
    whole = pieces.where("whole").select("part", "doc_start", "id", F.col("size").alias("n_ids"), "crc")

    @F.pandas_udf("long")
    def combined(pieces: pd.Series) -> pd.Series:
        return pd.Series([combine_crc32([(p["crc"], 4 * p["n"]) for p in some]) for some in pieces], dtype="int64")

    cut = pieces.where("not whole").groupBy(*_PLACE).agg(F.array_sort(F.collect_list(F.struct("block", "n", "crc"))).alias("pieces"))
    joined = cut.select("part", "doc_start", "id", F.col("size").alias("n_ids"), combined("pieces").alias("crc"))
    return _placed(whole.unionByName(joined), blocks, "n_ids", "crc")


# Checksums of joined pieces: a CRC-32 is a polynomial over GF(2), lowest power in the highest bit, modulo this one.
_CRC_POLY = 0xEDB88320


def _times(a: int, b: int) -> int:
    """The product of two polynomials."""
    product = 0
    for bit in range(31, -1, -1):
        if a >> bit & 1:
            product ^= b
        b = b >> 1 ^ (_CRC_POLY if b & 1 else 0)
    return product


@cache
def _shift(n_bytes: int) -> int:
    """x to the power of 8 times the number of bytes."""
    result, base = 1 << 31, 1 << 23
    while n_bytes:
        if n_bytes & 1:
            result = _times(result, base)
        base, n_bytes = _times(base, base), n_bytes >> 1
    return result


def combine_crc32(pieces: list[tuple[int, int]]) -> int:
    """The CRC-32 of joined pieces, from that of each and its number of bytes."""
    whole = 0
    for crc, n_bytes in pieces:
        whole = _times(_shift(n_bytes), whole) ^ crc
    return whole


#: Marks that join a letter into one, in bytes: a capital may have a joined form where its small letter has none.
_JOINING = re.compile("[\u0300-\u036f]")
#: Letters whose lower case or composed form could depend on more than themselves.
_OTHER = re.compile("[\u0130\u0250-\U0010ffff]")
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BLANK = np.zeros(256, bool)
_BLANK[[10, 32]] = True
_PLAIN = np.zeros(256, bool)  # ASCII letters and digits
_PLAIN[[*range(48, 58), *range(65, 91), *range(97, 123)]] = True
_STOP = np.zeros(256, bool)
_STOP[[44, 46]] = True


def cut_pieces(low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where pieces begin and end in UTF-8 bytes: runs between spaces and line feeds, a full stop or comma at the end of a
    plain word apart."""
    blank = _BLANK[low]
    last = np.append(blank[1:], True)
    plain = _PLAIN[low]
    # of two-byte letters, those from U+00C0 to U+00FF but the signs for multiplying and dividing
    latin = np.zeros(len(low), bool)
    latin[1:] = (low[:-1] == 0xC3) & (low[1:] >= 0x80) & (low[1:] < 0xC0) & (low[1:] != 0x97) & (low[1:] != 0xB7)
    apart = np.zeros(len(low), bool)
    apart[1:] = (plain | latin)[:-1] & _STOP[low[1:]] & last[1:]
    begins = ~blank & (np.append(True, blank[:-1]) | apart)
    ends = ~blank & (last | np.append(begins[1:], True))
    return np.flatnonzero(begins), np.flatnonzero(ends) + 1


class HashNumbers:
    """Numbers keys (64-bit hashes) in the order in which they are added; finds many at once by open addressing."""

    def __init__(self, most: int) -> None:
        bits = max(4, (2 * most).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.numbers, self.count = np.zeros(1 << bits, np.uint64), np.zeros(1 << bits, np.int32), 0

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key, or -1. No key is 0, the mark of a free place."""
        out = np.full(len(keys), -1, np.int64)
        left, at = np.arange(len(keys)), (keys >> self.shift).astype(np.int64)
        while len(left):
            there = self.keys[at]
            hit = there == keys[left]
            out[left[hit]] = self.numbers[at[hit]]
            on = ~hit & (there != 0)
            left, at = left[on], (at[on] + 1) & self.mask
        return out

    def add(self, keys: np.ndarray) -> None:
        """Distinct keys that aren't known."""
        numbers = np.arange(self.count, self.count + len(keys), dtype=np.int32)
        self.count += len(keys)
        at = (keys >> self.shift).astype(np.int64)
        while len(keys):
            free = np.flatnonzero(self.keys[at] == 0)
            _, first = np.unique(at[free], return_index=True)  # of those that want a place, one gets it
            won = free[first]
            self.keys[at[won]], self.numbers[at[won]] = keys[won], numbers[won]
            on = np.ones(len(keys), bool)
            on[won] = False
            keys, numbers, at = keys[on], numbers[on], (at[on] + 1) & self.mask


class PieceCoder:
    """Encodes texts with a tokenizer whose tokens never reach across a space or a line feed, and which lower-cases, puts
    punctuation apart and maps bytes to letters. Each piece between spaces is encoded once by the library and remembered,
    up to a bound, under a 64-bit hash of its bytes. So that fewer pieces differ, A-Z is lower-cased and a full stop or
    comma at a word's end put apart beforehand, as the tokenizer does anyway. Pieces that are a word go to the library's
    model directly, all others through the whole tokenizer; so do whole texts with joining marks."""

    def __init__(self, definition: str, end_id: int | None, most: int = 1_000_000, id_bytes: int = 4) -> None:
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_str(definition)
        self.model = self.tokenizer.model.tokenize
        self.kind = np.dtype(f"<u{id_bytes}")
        if self.tokenizer.get_vocab_size() > 1 << 8 * id_bytes:
            raise ValueError(f"ids of this tokenizer need more than {id_bytes} bytes")
        level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.letters: dict[int, str] = {}
        for c in map(chr, range(0xC0, 0x250)):
            self.letters.update(zip(c.encode(), level.pre_tokenize_str(c)[0][0], strict=True))
        self.end = [] if end_id is None else [end_id]
        self.most = most
        self._forget()

    def _forget(self) -> None:
        """`known` numbers the pieces by hash; `ids` holds their ids one after another, `used` of them, from `first` on.
        The arrays are longer than what they hold, so that learning doesn't copy them each time."""
        self.known = HashNumbers(2 * self.most)
        self.ids, self.used = np.zeros(1 << 16, self.kind), 0
        self.first, self.size = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)

    def _ids(self, piece: str) -> list[int]:
        if piece.isalpha() and piece.islower():
            if piece.isascii():
                return [t.id for t in self.model(piece)]
            if not _OTHER.search(piece):
                return [t.id for t in self.model(piece.encode().decode("latin-1").translate(self.letters))]
        return self.tokenizer.encode(piece, add_special_tokens=False).ids

    def _learn(self, keys: np.ndarray, pieces: list[bytes]) -> None:
        found, sizes = [], []
        for piece in pieces:
            ids = self._ids(piece.decode())
            found.extend(ids)
            sizes.append(len(ids))
        a, b = self.known.count, self.known.count + len(keys)
        self.known.add(keys)
        while self.used + len(found) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while b > len(self.size):
            self.first, self.size = (np.concatenate([x, np.zeros_like(x)]) for x in (self.first, self.size))
        self.ids[self.used : self.used + len(found)] = found
        self.size[a:b] = sizes
        self.first[a:b] = self.used + np.cumsum(self.size[a:b]) - self.size[a:b]
        self.used += len(found)

    def __call__(self, texts: list[str]) -> list[bytes]:
        """The packed ids of each text."""
        odd = [i for i, t in enumerate(texts) if not t.isascii() and _JOINING.search(t)]
        out = self._plain(["" if i in odd else t for i, t in enumerate(texts)] if odd else texts)
        for i in odd:
            found = self.tokenizer.encode(texts[i], add_special_tokens=False).ids
            out[i] = np.array([*found, *self.end], self.kind).tobytes()
        return out

    def _plain(self, texts: list[str]) -> list[bytes]:
        if self.known.count > self.most:
            self._forget()
        end = np.array(self.end, self.kind).tobytes()
        raw = [t.encode() for t in texts]
        joined = b"\n".join(raw)
        low = _LOWER[np.frombuffer(joined, np.uint8)]
        begins, ends = cut_pieces(low) if len(low) else (np.zeros(0, np.int64),) * 2
        if not len(begins):
            return [end] * len(texts)
        hashed = hash_runs(low, ~_BLANK[low], begins, ends)
        for k in np.flatnonzero(ends - begins > PLACES).tolist():
            hashed[k] = xxhash.xxh3_64_intdigest(low[begins[k] : ends[k]].tobytes())
        hashed[hashed == 0] = 1  # 0 is no key
        code = self.known.find(hashed)
        unknown = np.flatnonzero(code < 0)
        if len(unknown):
            keys, which = np.unique(hashed[unknown], return_index=True)
            self._learn(keys, [low[begins[k] : ends[k]].tobytes() for k in unknown[which].tolist()])
            code[unknown] = self.known.find(hashed[unknown])
        sizes = self.size[code]
        ids = self.ids[ragged(self.first[code], sizes)]
        before = np.concatenate([[0], np.cumsum(sizes)])
        edges = np.cumsum([0, *(len(r) + 1 for r in raw)])
        stops = before[np.searchsorted(begins, edges)].tolist()
        return [ids[a:b].tobytes() + end for a, b in zip(stops, stops[1:], strict=False)]


def encode_with(spark: SparkSession, definition: str, end_id: int | None = None, id_bytes: int = 4) -> Callable:
    """A column function: the packed ids of each whole text by a tokenizer's JSON definition, then the end id."""
    prepare(spark)
    sent, token = spark.sparkContext.broadcast(definition), uuid.uuid4().hex

    @F.pandas_udf("binary")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        coder = in_worker(token, lambda: PieceCoder(sent.value, end_id, id_bytes=id_bytes))
        for batch in batches:
            yield pd.Series([ids for part in chunks(batch, len, 1 << 18) for ids in coder(part)], dtype=object)

    return run


def write_tokenized(docs: DataFrame, definition: str, key: str = "doc_id", text: str = "text", end_id: int = 2,
                    block_ids: int = BLOCK_IDS, planes: str = "byte") -> DataFrame:
    """Encode all texts and write them as token files in key order; gives the block table.

    Null counts as empty and gives the end id alone; null keys come first; repeated rows are documents each, in the order of
    a hash of their ids; an empty table gives no blocks; other columns are never looked at. A very long text is encoded and
    held in one go by its task, and cut into blocks. Ids are written once, zstandard-compressed, before they are ordered, so
    that the range partitioner's sample doesn't encode all texts again. Ids travel in two bytes where the vocabulary allows
    it."""
    from tokenizers import Tokenizer

    spark = docs.sparkSession
    id_bytes = 2 if max(Tokenizer.from_str(definition).get_vocab_size(), end_id + 1) <= 1 << 16 else 4
    encode = encode_with(spark, definition, end_id, id_bytes)
    ids = keep_table(docs.select(col(key).alias("id"), encode(text_of(text)).alias("ids")), "ids")
    return write_token_files(ids, "ids", "id", block_ids=block_ids, planes=planes, id_bytes=id_bytes)


def tokenized(docs: DataFrame, definition: str, key: str = "doc_id", text: str = "text", end_id: int = 2,
              block_ids: int = BLOCK_IDS, planes: str = "byte") -> DataFrame:
    """`write_tokenized`, and the documents read back: id, start, ids."""
    return read_token_files(write_tokenized(docs, definition, key, text, end_id, block_ids, planes))
