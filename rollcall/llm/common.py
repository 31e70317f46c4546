"""What the text operators share: stage tables in the shared folder, free column names, word hashing."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterable
from pathlib import Path

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.session import new_path

#: Rows and bytes handed to a Python worker at once; long texts come in smaller batches.
BATCH_ROWS = 2_000
BATCH_BYTES = 8 << 20



_ready: set[str] = set()


def prepare(spark: SparkSession) -> None:
    """Bound what a Python worker holds, whatever the length of a text, and make this package known to the workers, as
    --py-files would."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    context = spark.sparkContext
    package = Path(__file__).resolve().parent.parent
    if context.applicationId not in _ready and package.is_dir():  # else it came as an archive already
        archive = Path(tempfile.mkdtemp(prefix="rollcall-")) / f"{package.name}.zip"
        with zipfile.ZipFile(archive, "w") as z:
            for file in sorted(package.rglob("*.py")):
                z.write(file, file.relative_to(package.parent))
        context.addPyFile(str(archive))  # copied and served by the driver
        _ready.add(context.applicationId)


def keep_table(df: DataFrame, name: str) -> DataFrame:
    """Write the rows as a table in the shared folder and read it back: lineage ends here, so a lost executor costs no
    more than the tasks it ran, and what two branches use is computed once. The table goes when the driver ends, or when
    the `dropping_tables` block of `rollcall.session` ends in which it was written."""
    path = new_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, name: str) -> str:
    """A column name that the frame doesn't use yet (names differ by more than case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def col(name: str) -> Column:
    """A column by its exact name, dots and spaces included."""
    return F.col("`" + name.replace("`", "``") + "`")


def text_of(name: str) -> Column:
    """The text as a string; null counts as empty."""
    return F.coalesce(col(name).cast("string"), F.lit(""))


def remainder(key: Column, n: int) -> Column:
    """crc32 of the key as text, modulo n; null where the key is null."""
    return F.crc32(key.cast("string").cast("binary")) % n


def is_small(df: DataFrame, most_rows: int, most_bytes: int = 32 << 20) -> bool:
    """Whether a table may be broadcast: its rows, and the bytes of its values as text, are counted and within bounds."""
    size = sum((F.coalesce(F.octet_length(col(c).cast("string")), F.lit(0)) for c in df.columns), F.lit(0))
    found = df.agg(F.count("*").alias("rows"), F.sum(size).alias("bytes")).first()
    return found["rows"] <= most_rows and (found["bytes"] or 0) <= most_bytes


def bit_plane(cells: DataFrame, n: int) -> np.ndarray:
    """A bit map of n bits (a power of two), as 32-bit words: those in the column cell are set. What comes to the driver
    is bounded by n, whatever the number of rows; n is the caller's bound."""
    words = (
        cells.groupBy(F.shiftright("cell", 5).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(cell & 31 as int))")).alias("bits"))
        .toPandas()
    )
    plane = np.zeros(max(1, n // 32), np.uint32)
    plane[words["word"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64).astype(np.uint32)
    return plane


def in_plane(plane: np.ndarray, cells: np.ndarray) -> np.ndarray:
    return (plane[cells >> 5] >> (cells & 31).astype(np.uint32)) & 1 == 1


# Hashing ----------------------------------------------------------------------------------------------------------

_A, _B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers whose output bits all depend on all input bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * _A
    x ^= x >> np.uint64(27)
    x *= _B
    x ^= x >> np.uint64(31)
    return x


def mix_one(x: int) -> int:
    """`mix` of one number."""
    x &= 0xFFFFFFFFFFFFFFFF
    x = (x ^ (x >> 30)) * 0xBF58476D1CE4E5B9 & 0xFFFFFFFFFFFFFFFF
    x = (x ^ (x >> 27)) * 0x94D049BB133111EB & 0xFFFFFFFFFFFFFFFF
    return x ^ (x >> 31)


#: Bytes of a run that are told apart by their places when runs are hashed.
PLACES = 256
_WEIGHTS = mix(np.arange(1, PLACES + 1, dtype=np.uint64)) | np.uint64(1)


def hash_runs(text: np.ndarray, inside: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of runs of bytes, all at once. `inside` marks the bytes that belong to runs. Of runs of more than
    PLACES bytes, the rest counts without its order."""
    if not len(begins):
        return np.zeros(0, np.uint64)
    first = np.zeros(len(text), np.int64)
    first[begins] = begins
    place = np.arange(len(text)) - np.maximum.accumulate(first)
    weighed = _WEIGHTS[np.minimum(place, PLACES - 1)] * (text.astype(np.uint64) + np.uint64(1))
    weighed[~inside] = 0
    return mix(np.add.reduceat(weighed, begins) + (ends - begins).astype(np.uint64))


class WordHashes:
    """64-bit hashes of words, remembered up to a bound so that memory doesn't follow the vocabulary."""

    def __init__(self, most: int = 400_000) -> None:
        self.most = most
        self.known: dict[bytes, int] = {}

    def __call__(self, words: list[bytes]) -> np.ndarray:
        import xxhash

        known = self.known
        if len(known) > self.most:
            known.clear()
        hashed = xxhash.xxh3_64_intdigest
        for w in set(words).difference(known):
            known[w] = hashed(w)
        return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


class Learned(dict):
    """A dictionary that works out what it lacks."""

    def __init__(self, learn) -> None:
        super().__init__()
        self.learn = learn

    def __missing__(self, key):
        found = self[key] = self.learn(key)
        return found


_kept: dict[str, object] = {}


def in_worker(token: str, make):
    """What `make` gives, once a worker and token: a worker that runs many tasks of a job keeps what it has worked out.
    Only the latest is kept, so that stages that follow each other in a worker don't add up."""
    if token not in _kept:
        _kept.clear()
        _kept[token] = make()
    return _kept[token]


def chunks(items: Iterable, weight, most: int):
    """Lists of consecutive items whose weights add up to `most` at the most, one item at the least."""
    held, total = [], 0
    for x in items:
        w = weight(x)
        if held and total + w > most:
            yield held
            held, total = [], 0
        held.append(x)
        total += w
    if held:
        yield held


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indices start, start + 1, ... of every run, one run after another."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    out = np.ones(total, np.int64)
    ends = np.cumsum(lengths)
    full = np.flatnonzero(lengths)
    first = (ends - lengths)[full]
    out[first] = starts[full]
    out[first[1:]] -= starts[full][:-1] + lengths[full][:-1] - 1
    return np.cumsum(out)
