"""Hidden Markov language model, trained by Baum-Welch over partitions and scored by the exact forward recursion.

Words (bytes between ASCII white space, A-Z in lower case) and one end token a text form the sequence. Hidden states emit
classes: each of the `head` most frequent words has a class, and every other word belongs by its hash to one of the classes
of rare words (up to `rare` of them, as the distinct rare words ask for), within which it has the probability (c + 1) / (mass
of the class + its distinct words + 1); c is its count in the training texts, and an unknown word has c = 0. So the model is
a proper distribution over all words, its tables have a fixed bound ((head + rare) x states), and every word's count enters.

Expected counts of an iteration are worked out by each task and added up by class in Spark. Emissions are smoothed by the
unigram distribution. Texts are scored whole: the scaled forward recursion runs over many texts side by side, and its
logarithms add up to the exact log probability of the text under the model.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.llm.common import col, keep_table, prepare, remainder, text_of

END = 0  # classes of rare words follow, then those of the head
#: Texts run side by side at the most, cells (position, text) of one block, and tokens gathered before they are put side
#: by side, so that long texts find neighbours.
SIDE, BLOCK, POOL = 1024, 1 << 18, 1 << 21
#: Steps between two scalings. Probabilities of a step stay above 1e-12, so 16 of them are far from the smallest number.
EVERY = 16
#: Positions whose variables are held at once. Of longer texts the forward variables are kept at the edges of such segments,
#: and worked out again within each on the way back.
SEGMENT = 1 << 15
#: Distinct rare words for each of their classes, and bytes of text that are split into words at once.
RARE_WORDS, WINDOW = 200, 1 << 20


@dataclass(frozen=True)
class Settings:
    states: int = 8
    head: int = 60_000  # classes fit 16 bits
    rare: int = 4_096
    iterations: int = 3
    prior: float = 1000.0  # emissions of the unigram distribution that each state starts with
    stay: float = 0.999  # of the first model: states keep to themselves, so that kinds of text part before words do
    seed: int = 11


@dataclass
class Model:
    settings: Settings
    start: np.ndarray  # (states)
    move: np.ndarray  # (states, states)
    emit: np.ndarray  # (classes, states)


def words_of(text: str) -> list[bytes]:
    """Maximal runs of bytes other than ASCII white space, A-Z in lower case."""
    return text.encode().lower().split()


_SPACE = re.compile(rb"[\x09-\x0d ]")


def word_parts(text: str, size: int = WINDOW) -> Iterator[list[bytes]]:
    """`words_of` in parts of about `size` bytes, so that the words of a long text aren't held together."""
    raw, at = text.encode().lower(), 0
    while len(raw) - at > size and (space := _SPACE.search(raw, at + size)):
        yield raw[at : space.start()].split()
        at = space.end()
    yield raw[at:].split()


# Counting ------------------------------------------------------------------------------------------------------------


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, n) over the column text, words as binary. Tasks count before they shuffle, and empty their counter when it
    has grown large."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter = Counter()
        for batch in batches:
            for words in (words for text in batch["text"] for words in word_parts(text)):
                seen.update(words)
                if len(seen) > 500_000:
                    yield pd.DataFrame({"word": list(seen), "n": list(seen.values())})
                    seen = Counter()
        if seen:
            yield pd.DataFrame({"word": list(seen), "n": list(seen.values())})

    return texts.mapInPandas(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


@dataclass
class Vocabulary:
    """Counts of the training texts: of the head words by class, and of the rare words of each class together."""

    head: dict[bytes, int]
    counts: np.ndarray  # by class; of a class of rare words their mass
    tokens: int  # N, end tokens included
    distinct: int  # V, the end token included
    rare_distinct: np.ndarray  # by class of rare words

    @property
    def n_rare(self) -> int:
        return len(self.rare_distinct)

    @property
    def base(self) -> float:
        """What a token of count c has (c + 1) divided by."""
        return self.tokens + self.distinct + 1

    @property
    def rare_base(self) -> np.ndarray:
        """The same within each class of rare words."""
        return self.counts[1 : 1 + self.n_rare] + self.rare_distinct + 1.0

    @property
    def unigram(self) -> np.ndarray:
        p = self.counts + 1.0
        p[1 : 1 + self.n_rare] = self.rare_base
        return p / p.sum()

    def classes(self, words: list[bytes]) -> np.ndarray:
        found = np.fromiter(map(self.head.get, words, repeat(0)), np.uint16, len(words))
        rare = np.flatnonzero(found == 0)
        found[rare] = [1 + zlib.crc32(words[i]) % self.n_rare for i in rare.tolist()]
        return found


def frequent(counts: DataFrame, head: int) -> list[tuple[bytes, int]]:
    """The `head` most frequent words (all, if fewer) with their counts, most frequent first; of equally frequent ones those
    with the lowest hash. They are chosen by histograms: of counts in steps of 4 in 100, within the step that doesn't fit
    whole of counts, within that count of hashes, and only the last bucket is sorted. So no task sends more than its share."""
    step, bucket = F.floor(F.log2("n") * 16).cast("int"), F.pmod(F.xxhash64("word"), F.lit(1 << 16))

    def fitting(some: DataFrame, by: Column, left: int, falling: bool) -> tuple[int | None, int]:
        """The first value that doesn't fit whole, and what is left for it."""
        for r in sorted(some.groupBy(by.alias("at")).count().collect(), key=lambda r: -r["at"] if falling else r["at"]):
            if r["count"] > left:
                return r["at"], left
            left -= r["count"]
        return None, left

    at_step, left = fitting(counts, step, head, True)
    if at_step is None:
        chosen = [counts]
    else:
        some = counts.where(step == at_step)
        at_n, left = fitting(some, F.col("n"), left, True)
        same = some.where(F.col("n") == at_n)
        at_bucket, left = fitting(same, bucket, left, False)
        last = same.where(bucket == at_bucket).orderBy(F.xxhash64("word"), "word").limit(left)
        chosen = [counts.where(step > at_step), some.where(F.col("n") > at_n), same.where(bucket < at_bucket), last]
    found = [(bytes(r["word"]), r["n"]) for part in chosen for r in part.collect()]
    return sorted(found, key=lambda r: (-r[1], r[0]))


def vocabulary(counts: DataFrame, texts: int, head: int, rare: int) -> Vocabulary:
    """The most frequent words, `head` of them, come to the driver; of the others, only sums by class."""
    found = frequent(counts, head)
    totals = counts.agg(F.count("*").alias("words"), F.sum("n").alias("n")).first()
    distinct, mass = totals["words"], totals["n"] or 0
    n_rare = max(1, min(rare, (distinct - len(found)) // RARE_WORDS))
    sums, words = np.zeros(n_rare), np.zeros(n_rare)
    by_class = counts.groupBy((F.crc32("word") % n_rare).alias("class")).agg(F.sum("n").alias("n"), F.count("*").alias("words"))
    for r in by_class.collect():
        sums[r["class"]], words[r["class"]] = r["n"], r["words"]
    for word, n in found:
        k = zlib.crc32(word) % n_rare
        sums[k] -= n
        words[k] -= 1
    return Vocabulary(
        {w: k + 1 + n_rare for k, (w, _) in enumerate(found)},
        np.array([texts, *sums, *(n for _, n in found)], np.float64),
        mass + texts,
        distinct + (texts > 0),
        words,
    )


def encoded(docs: DataFrame, words: Vocabulary) -> DataFrame:
    """A row a text (id, held, text): a number of its own, its classes as 16-bit integers, its tokens, what its head
    words add to n_known and base_score, its other words with their counts, and the logarithms of what these are divided by
    within their classes."""
    sent = docs.sparkSession.sparkContext.broadcast(words)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        words = sent.value
        logs = np.log10((words.counts + 1) / words.base)
        rare_logs = np.log10(words.rare_base)
        uid = TaskContext.get().partitionId() << 40
        known = words.counts > 0
        for batch in batches:
            rows = []
            for key, held, text in zip(batch["id"], batch["held"], batch["text"], strict=True):
                parts, rare, sums = [], Counter(), [int(known[END]), float(logs[END]), 0.0]
                for found in word_parts(text):
                    ids = words.classes(found)
                    is_rare = ids <= words.n_rare
                    rare.update([found[i] for i in np.flatnonzero(is_rare).tolist()])
                    common = ids[~is_rare]
                    sums[0] += int(known[common].sum())
                    sums[1] += float(logs[common].sum())
                    sums[2] += float(rare_logs[ids[is_rare] - 1].sum())
                    parts.append(ids)
                parts.append(np.array([END], np.uint16))
                packed = b"".join(x.tobytes() for x in parts)
                rows.append((uid, key, held, packed, len(packed) // 2, *sums, list(rare), list(rare.values())))
                uid += 1
            yield pd.DataFrame(rows, columns=["uid", "id", "held", "ids", "n", "known", "base", "within", "rare", "times"])

    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInPandas(
        run,
        f"uid long, id {kind}, held boolean, ids binary, n long, known long, base double, within double, "
        "rare array<binary>, times array<long>",
    )


# The recursion -------------------------------------------------------------------------------------------------------


def side_by_side(texts: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Blocks of texts of like length, longest first: their places, a matrix (position, text) of classes, their lengths."""
    order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
    at = 0
    while at < len(order):
        longest = len(texts[order[at]])
        n = max(1, min(SIDE, BLOCK // longest))
        places = order[at : at + n]
        lengths = np.array([len(texts[i]) for i in places])
        grid = np.zeros((longest, len(places)), np.uint16)
        for k, i in enumerate(places):
            grid[: lengths[k], k] = texts[i]
        yield np.array(places), grid, lengths
        at += n


def _active(lengths: np.ndarray, steps: int) -> list[int]:
    """At each position, how many texts (the first ones) reach it."""
    return np.searchsorted(-lengths, -np.arange(1, steps + 1), side="right").tolist()


def _forward(model: Model, given: np.ndarray, active: list[int], before: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The forward variables (position, text, state), scaled now and then, and the logarithm of what was divided out.
    `given` holds the emission of each cell's class; past a text's end all is 0. `before` holds the variables of the
    position before, where the positions aren't the first ones."""
    ahead = np.zeros_like(given)
    logs = np.zeros(given.shape[1])
    for t in range(len(active)):
        n = active[t]
        if t == 0 and before is None:
            np.multiply(model.start, given[0], out=ahead[0])
            continue
        last = before if t == 0 else ahead[t - 1]
        if t % EVERY == 0:
            scale = last[:n].sum(1)
            last[:n] /= scale[:, None]
            logs[:n] += np.log10(scale)
        np.matmul(last[:n], model.move, out=ahead[t, :n])
        ahead[t, :n] *= given[t, :n]
    return ahead, logs


def _segments(steps: int) -> list[tuple[int, int]]:
    return [(a, min(steps, a + SEGMENT)) for a in range(0, steps, SEGMENT)]


def log_likelihoods(model: Model, texts: list[np.ndarray]) -> np.ndarray:
    """log10 of the probability of each sequence of classes, by the scaled forward recursion, a segment after another."""
    out = np.zeros(len(texts))
    for places, grid, lengths in side_by_side(texts):
        active, before, done = _active(lengths, len(grid)), None, np.zeros(len(places))
        for a, b in _segments(len(grid)):
            ahead, logs = _forward(model, model.emit[grid[a:b]], active[a:b], before)
            done += logs
            ends = np.flatnonzero((lengths > a) & (lengths <= b))
            out[places[ends]] = done[ends] + np.log10(ahead[lengths[ends] - 1 - a, ends].sum(1))
            before = ahead[-1].copy()
    return out


def expected_counts(model: Model, texts: list[np.ndarray], start: np.ndarray, move: np.ndarray, emit: np.ndarray) -> None:
    """Add the expected starts, moves and emissions of the texts. Each position's state distribution is the product of
    the forward and backward variables, whatever their scales, divided by its sum. Of long texts only the forward variables
    at the edges of segments are kept; the way back works those within a segment out again."""
    for _, grid, lengths in side_by_side(texts):
        active, before, edges = _active(lengths, len(grid)), None, []
        segments = _segments(len(grid))
        for a, b in segments[:-1]:
            edges.append(before)
            before = _forward(model, model.emit[grid[a:b]], active[a:b], None if before is None else before.copy())[0][-1].copy()
        edges.append(before)
        after = None
        for (a, b), before in zip(reversed(segments), reversed(edges), strict=True):
            after = _add_segment(model, grid[a:b], active[a:b], lengths - a, before, after, start, move, emit)


def _add_segment(model: Model, grid: np.ndarray, active: list[int], lengths: np.ndarray, before: np.ndarray | None,
                 after: np.ndarray | None, start: np.ndarray, move: np.ndarray, emit: np.ndarray) -> np.ndarray:
    """Add what the positions of a segment expect, and the moves out of it. `before` and what is returned are the variables
    of the positions on either side: forward ones, and `after` the emissions times backward ones, 0 for texts that ended."""
    s, size = len(model.start), len(grid)
    given = model.emit[grid]
    ahead, _ = _forward(model, given, active, before)
    back = np.zeros_like(given)
    ends = np.flatnonzero((lengths > 0) & (lengths <= size))
    back[lengths[ends] - 1, ends] = 1
    if after is not None:
        on = np.flatnonzero(lengths > size)
        back[-1, on] = after[on] @ model.move.T
    follow = given  # from here on: the emission of a cell times its backward variable
    for t in range(size - 1, -1, -1):
        n = active[t]
        follow[t, :n] *= back[t, :n]
        follow[t, n:] = 0
        if t % EVERY == 0:
            follow[t, :n] /= follow[t, :n].max(1, keepdims=True)
        if t:  # texts that end at t - 1 keep the 1 that was set
            np.matmul(follow[t, :n], model.move.T, out=back[t - 1, :n])
    total = np.einsum("tns,tns->tn", ahead, back)
    total[total == 0] = 1  # past the end of a text all is 0
    ahead /= total[:, :, None]
    # a move's weight is ahead[t] x move x follow[t + 1] over the same sum
    move += model.move * (ahead[:-1].reshape(-1, s).T @ follow[1:].reshape(-1, s))
    if after is not None:
        move += model.move * (ahead[-1].T @ after)
    ahead *= back
    if before is None:
        start += ahead[0].sum(0)
    classes = grid.ravel()
    for k in range(s):
        emit[:, k] += np.bincount(classes, ahead[:, :, k].ravel(), len(emit))
    return follow[0]


def _pools(batches: Iterator[pd.DataFrame]) -> Iterator[list[np.ndarray]]:
    """The batches' texts in lists of at least POOL tokens, but for the last."""
    held, tokens = [], 0
    for batch in batches:
        for packed in batch["ids"]:
            held.append(np.frombuffer(packed, np.uint16))
            tokens += len(held[-1])
        if tokens >= POOL:
            yield held
            held, tokens = [], 0
    if held:
        yield held


def first_model(words: Vocabulary, settings: Settings) -> Model:
    """The unigram distribution in every state, disturbed so that states can part, and states that seldom change."""
    rng, s = np.random.default_rng(settings.seed), settings.states
    emit = words.unigram[:, None] * rng.uniform(0.3, 1.7, (len(words.counts), s))
    move = settings.stay * np.eye(s) + (1 - settings.stay) / s
    return Model(settings, np.full(s, 1 / s), move, emit / emit.sum(0))


def improved(model: Model, words: Vocabulary, counted: pd.DataFrame) -> Model:
    """The maximum step, from rows (class, s0, s1, ...); classes -1 and below hold the starts and the moves."""
    s = model.settings.states
    columns = [f"s{k}" for k in range(s)]
    rows, values = counted["class"].to_numpy(), counted[columns].to_numpy(np.float64)
    start, move, emit = np.zeros(s), np.zeros((s, s)), np.zeros(model.emit.shape)
    for k in np.flatnonzero(rows < 0):
        if rows[k] == -1:
            start += values[k]
        else:
            move[-2 - rows[k]] += values[k]
    emit[rows[rows >= 0]] += values[rows >= 0]
    start, move = start + 1 / s, move + 1 / s
    emit += model.settings.prior * words.unigram[:, None]
    return replace(model, start=start / start.sum(), move=move / move.sum(1, keepdims=True), emit=emit / emit.sum(0))


def baum_welch(training: DataFrame, words: Vocabulary, settings: Settings) -> Model:
    """Train on all rows of `training` (ids). Each iteration reads them once; what a task sends on is a row a class that
    it has met, and what reaches the driver is one row a class: the head's bound."""
    model, context = first_model(words, settings), training.sparkSession.sparkContext
    s = settings.states
    columns = [f"s{k}" for k in range(s)]
    schema = ", ".join(["class int", *(f"{c} float" for c in columns)])
    for _ in range(settings.iterations):
        sent = context.broadcast(model)

        def run(batches: Iterator[pd.DataFrame], sent=sent) -> Iterator[pd.DataFrame]:
            model = sent.value
            start, move, emit = np.zeros(s), np.zeros((s, s)), np.zeros(model.emit.shape)
            for texts in _pools(batches):
                expected_counts(model, texts, start, move, emit)
            met = np.flatnonzero(emit.sum(1))
            if len(met):
                table = np.concatenate([start[None], move, emit[met]]).astype(np.float32)
                out = pd.DataFrame(table, columns=columns)
                out.insert(0, "class", np.concatenate([-1 - np.arange(s + 1), met]).astype(np.int32))
                yield out

        sums = training.select("ids").mapInPandas(run, schema).groupBy("class")
        model = improved(model, words, sums.agg(*(F.sum(c).alias(c) for c in columns)).toPandas())
        sent.unpersist()
    return model


def _with_likelihood(model: Model, batches: list[pd.DataFrame]) -> pd.DataFrame:
    rows = pd.concat(batches, ignore_index=True)
    rows["hmm"] = log_likelihoods(model, [np.frombuffer(b, np.uint16) for b in rows.pop("ids")])
    return rows


def scored(docs: DataFrame, key: str = "doc_id", text: str = "text", folds: int = 7, held_fold: int = 2,
           settings: Settings = Settings()) -> DataFrame:
    """Train on the rows whose crc32(key as text) mod `folds` isn't `held_fold`, and score all rows.

    Returns the key, held_out, n_tokens, n_known (tokens met in training), train_tokens, base_score (the add-one unigram
    model) and score (log10 probability under the HMM). Null texts count as empty: their one token is the end. Rows
    without a key are trained on. Without any training text both models give unknown words and the end what smoothing
    leaves them. Rows that repeat are trained on and scored each; an empty table gives no rows; other columns are never
    looked at. A very long text is read in parts; of it a task holds its classes, two bytes a token, and one segment of the
    recursion.
    """
    spark = docs.sparkSession
    prepare(spark)
    held = F.coalesce(remainder(col(key), folds) == held_fold, F.lit(False))
    rows = docs.select(col(key).alias("id"), held.alias("held"), text_of(text).alias("text"))
    training = rows.where("not held")
    counts = keep_table(word_counts(training.select("text")), "word_counts")
    words = vocabulary(counts, training.count(), settings.head, settings.rare)
    table = keep_table(encoded(rows, words), "classes")
    model = baum_welch(table.where("not held"), words, settings)
    sent, base = spark.sparkContext.broadcast(model), words.base

    def likelihoods(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, tokens = [], 0
        for batch in batches:
            held.append(batch)
            tokens += int(batch["n"].sum())
            if tokens >= POOL:
                yield _with_likelihood(sent.value, held)
                held, tokens = [], 0
        if held:
            yield _with_likelihood(sent.value, held)

    rare = (
        table.select("uid", F.inline(F.arrays_zip(F.col("rare").alias("word"), F.col("times").alias("tf"))))
        .join(counts, "word", "left").withColumn("n", F.coalesce("n", F.lit(0)))
        .groupBy("uid").agg(
            F.sum(F.when(F.col("n") > 0, F.col("tf")).otherwise(0)).alias("rare_known"),
            F.sum(F.col("tf") * F.log10((F.col("n") + 1) / F.lit(base))).alias("rare_log"),
            F.sum("tf").alias("rare_n"),
        )
    )
    kind = table.schema["id"].dataType.simpleString()
    head = table.select("uid", "id", "held", "n", "known", "base", "within", "ids").mapInPandas(
        likelihoods, f"uid long, id {kind}, held boolean, n long, known long, base double, within double, hmm double"
    )
    zero = F.lit(0)
    return head.join(rare, "uid", "left").select(
        F.col("id").alias(key),
        F.col("held").alias("held_out"),
        F.col("n").alias("n_tokens"),
        (F.col("known") + F.coalesce("rare_known", zero)).alias("n_known"),
        F.lit(words.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("rare_log", zero)).alias("base_score"),
        # log((c + 1) / rare base) of each rare word is its base score with another divisor
        (F.col("hmm") + F.coalesce(F.col("rare_log") + F.col("rare_n") * math.log10(base), zero) - F.col("within")).alias("score"),
    )
