"""Toxicity by a small convolutional network over hashed word embeddings, in numpy.

A word's embedding is the mean of the hashed buckets of the whole word and of its first letters, so that unseen forms of
a known stem score too. Filters of several widths slide over the text, each keeps its largest answer (max pooling), and a
logistic unit weighs them. The text is read whole: one bad word in a book still reaches the pool.

Everything is learned from all labelled rows of the training folds, each text whole. A fifth of them, by a hash of the
key, is held back to calibrate: first the score, then a threshold for each language. The others give the odds of words and
train the network: they are dealt to blocks by a hash, one task descends over a block at a time, and after each pass the
blocks' changes are averaged (iterative parameter mixing). Counts, sums of changes and bins of scores are added up by
Spark; the driver holds what has the size of the model, a few MB whatever the input, and broadcasts it. Language decides
only the threshold, never the score.
"""

from __future__ import annotations

import copy
import re
import uuid
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, groupby
from operator import itemgetter

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.llm.common import Learned, chunks, col, free_name, in_worker, keep_table, prepare, remainder, text_of

_WORD = re.compile(r"\w+")
PREFIXES = (3, 4, 5, 6)


@dataclass(frozen=True)
class Settings:
    train_rows: int = 6_000  # of a block, until there are `blocks` of them
    blocks: int = 256
    passes: int = 2  # over the rows, at the least; `epochs` where one block holds them
    train_words: int = 1_800  # of a text that `telling_words` shortens
    around: int = 20  # words on either side of a telling word of a longer text
    buckets: int = 1 << 15
    dim: int = 12
    widths: tuple[int, ...] = (1, 2, 3)
    filters: int = 8
    epochs: int = 8
    batch: int = 32
    rate: float = 0.05
    seed: int = 7


def word_buckets(word: str, buckets: int, stems: dict[str, list[int]] | None = None) -> list[int]:
    """Bucket numbers of the word and of its beginnings; 0 is kept for "no word". `stems` remembers the beginnings."""
    stem = word[: PREFIXES[-1]]
    found = stems.get(stem) if stems else None
    if found is None:
        found = [1 + zlib.crc32(("^" + stem[:n]).encode()) % (buckets - 1) for n in PREFIXES if len(stem) >= n]
        if stems is not None:
            stems[stem] = found
    return [1 + zlib.crc32((word + "$").encode()) % (buckets - 1), *found]


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


#: Padding words after each text, so that no window reaches into the next.
GAP = 4
#: Buckets of a word, at the most.
WIDTH = 1 + len(PREFIXES)
NONE = [0] * WIDTH


class Numbered:
    """Words as row numbers of a table of buckets (`grid`, 0 where a word has fewer); row 0 is padding. Grows to `most` words,
    then starts anew."""

    def __init__(self, buckets: int, most: int = 100_000) -> None:
        self.buckets, self.most = buckets, most
        self.clear()

    def clear(self) -> None:
        self.anew = True
        self.rows: dict[str, int] = Learned(self._number)
        self.rows[""] = 0
        self.grid = np.zeros((1, WIDTH), np.int32)
        self.fresh = array("i")
        self.stems: dict[str, list[int]] = {}

    def _number(self, word: str) -> int:
        found = word_buckets(word, self.buckets, self.stems)
        self.fresh.extend(found)
        self.fresh.extend(NONE[len(found) :])
        return len(self.rows)

    def __call__(self, texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Row numbers of all words with padding after each text, and where each text begins."""
        if len(self.rows) > self.most:
            self.clear()
        flat, starts, at, number = [], [], 0, self.rows.__getitem__
        for words in texts:
            starts.append(at)
            flat.append(np.fromiter(map(number, words), np.int64, len(words)))
            flat.append(np.zeros(GAP, np.int64))
            at += len(words) + GAP
        if self.fresh:
            self.grid = np.concatenate([self.grid, np.array(self.fresh, np.int32).reshape(-1, WIDTH)])
            self.fresh = array("i")
        return np.concatenate(flat) if flat else np.zeros(0, np.int64), np.array(starts, np.int64)

    @property
    def lists(self) -> list[list[int]]:
        """The buckets of every row."""
        return [[b for b in row if b] or [0] for row in self.grid.tolist()]


def vectors_of(grid: np.ndarray, table: np.ndarray) -> np.ndarray:
    """`embed` of rows of a grid."""
    return table[grid].sum(1) / n_buckets(grid)[:, None]


def n_buckets(grid: np.ndarray) -> np.ndarray:
    return np.maximum((grid > 0).sum(1), 1).astype(np.float32)


def embed(lists: list[list[int]], table: np.ndarray) -> np.ndarray:
    """The mean bucket vector of every bucket list."""
    lengths = np.fromiter(map(len, lists), np.int64, len(lists))
    flat = np.fromiter(chain.from_iterable(lists), np.int64, int(lengths.sum()))
    sums = np.add.reduceat(table[flat], np.cumsum(lengths) - lengths, axis=0)
    return sums / lengths[:, None].astype(np.float32)


@dataclass
class Network:
    settings: Settings
    table: np.ndarray  # bucket vectors; row 0 is zero
    kernel: list[np.ndarray]  # for each width: (width, dim, filters)
    bias: np.ndarray
    out: np.ndarray
    base: float

    @classmethod
    def new(cls, s: Settings) -> Network:
        rng = np.random.default_rng(s.seed)
        table = rng.normal(0, 0.1, (s.buckets, s.dim)).astype(np.float32)
        table[0] = 0
        kernel = [rng.normal(0, 0.4 / w**0.5, (w, s.dim, s.filters)).astype(np.float32) for w in s.widths]
        n = s.filters * len(s.widths)
        return cls(s, table, kernel, np.zeros(n, np.float32), rng.normal(0, 0.2, n).astype(np.float32), 0.0)

    def answers(self, words: np.ndarray) -> np.ndarray:
        """What each filter row says to each word alone: (words, sum of widths x filters)."""
        return words @ np.concatenate([k.transpose(1, 0, 2).reshape(self.settings.dim, -1) for k in self.kernel], axis=1)

    def lines(self, answers: np.ndarray, ids: np.ndarray) -> Iterator[np.ndarray]:
        """For each width, what its filters say at each position."""
        f, n, at = self.settings.filters, len(ids), 0
        for w in self.settings.widths:
            line = answers[ids, at : at + f]
            for j in range(1, w):
                line[: n - j] += answers[ids[j:], at + j * f : at + (j + 1) * f]
            at += w * f
            yield line

    def pool(self, answers: np.ndarray, ids: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """The largest answer of each filter in each text. One padding word counts, so that an empty text has one."""
        cuts = np.stack([starts, text_ends(starts, len(ids))], 1).ravel()
        tops = [np.maximum.reduceat(line, cuts, axis=0)[::2] for line in self.lines(answers, ids)]
        return np.concatenate(tops, axis=1) + self.bias

    def logits(self, pooled: np.ndarray) -> np.ndarray:
        return np.maximum(pooled, 0) @ self.out + self.base


def text_ends(starts: np.ndarray, n: int) -> np.ndarray:
    return np.append(starts[1:], n) - GAP + 1


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(np.asarray(z, np.float64), -40, 40)))


class Scorer:
    """Scores texts with a trained network; what the filters say to a word is worked out once."""

    def __init__(self, network: Network) -> None:
        self.network, self.numbered = network, Numbered(network.settings.buckets)
        self.answers = np.zeros((0, 0), np.float32)

    def __call__(self, texts: list[str]) -> np.ndarray:
        return sigmoid(self.logits(texts))

    def logits(self, texts: list[str]) -> np.ndarray:
        ids, starts = self.numbered([words_of(t) for t in texts])
        known = 0 if self.numbered.anew else len(self.answers)
        self.numbered.anew = False
        if len(fresh := self.numbered.grid[known:]):
            said = self.network.answers(vectors_of(fresh, self.network.table))
            self.answers = np.concatenate([self.answers[:known], said]) if known else said
        return self.network.logits(self.network.pool(self.answers, ids, starts))


# Training ----------------------------------------------------------------------------------------------------------


class Adagrad:
    def __init__(self, rate: float, like: dict[str, np.ndarray]) -> None:
        self.rate, self.seen = rate, {name: np.full(value.shape, 1e-4, np.float32) for name, value in like.items()}

    def step(self, name: str, value: np.ndarray, grad: np.ndarray, rows=slice(None)) -> None:
        seen = self.seen[name]
        seen[rows] += grad * grad
        value[rows] -= self.rate * grad / np.sqrt(seen[rows])


def bucket_counts(seen: np.ndarray, texts: list[list[str]], numbered: Numbered) -> None:
    """Add in how many of the texts each bucket occurs."""
    ids, starts = numbered([list(set(words)) for words in texts])
    met = np.zeros(len(seen), bool)
    for own in np.split(ids, starts[1:]):
        met[numbered.grid[own]] = True
        seen[np.flatnonzero(met)] += 1
        met[:] = False
    seen[0] = 0


def log_odds(seen: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """The smoothed log odds of each bucket, from the clean and the toxic texts that hold it (two rows) and their numbers."""
    share = (seen + 1) / (totals[:, None] + 2)
    odds = np.clip(np.log(share[1] / share[0]) * seen.sum(0) / (seen.sum(0) + 4), -4, 4)
    odds[0] = 0
    return odds.astype(np.float32)


def telling_words(words: list[str], odds: np.ndarray, s: Settings) -> list[str]:
    """A text in short, for people who look at what was found: all of it, or of a longer one the windows around the words of
    the highest odds. Training and scores read texts whole."""
    if len(words) <= s.train_words:
        return words
    of = {w: odds[word_buckets(w, s.buckets)].max() for w in set(words)}
    said = np.fromiter(map(of.__getitem__, words), np.float32, len(words))
    chosen = np.zeros(len(words), bool)
    for k in np.argsort(-said, kind="stable")[: s.train_words // (2 * s.around + 1)].tolist():
        chosen[max(0, k - s.around) : k + s.around + 1] = True
    return [words[k] for k in np.flatnonzero(chosen).tolist()]


def first_network(odds: np.ndarray, s: Settings) -> Network:
    """Each bucket starts, in its first dimension, from its log odds, and the first filter of each width reads it: a maximum
    passes gradients to winners only, and random winners teach slowly."""
    net = Network.new(s)
    net.table[:, 0] = odds
    net.table[0] = 0
    for k in net.kernel:
        k[:, :, 0] *= 0.1
        k[:, 0, 0] = 0.5
    net.out[:: s.filters] = 0.5
    return net


class Training:
    """A network under gradient descent on the log loss. Only the word windows that win a maximum have gradients."""

    def __init__(self, net: Network) -> None:
        self.net, s = net, net.settings
        self.small = {"base": np.array([net.base], np.float32), "out": net.out, "bias": net.bias}
        self.small |= {f"kernel{k}": kernel for k, kernel in enumerate(net.kernel)}
        self.adagrad = Adagrad(s.rate, self.small | {"table": net.table})

    def batch(self, texts: list[list[str]], toxic: np.ndarray, numbered: Numbered) -> None:
        net, s, adagrad = self.net, self.net.settings, self.adagrad
        all_ids, starts = numbered(texts)
        words, ids = np.unique(all_ids, return_inverse=True)
        grid = numbered.grid[words]
        vectors = vectors_of(grid, net.table)
        answers, ends = net.answers(vectors), text_ends(starts, len(ids))
        tops, spots = [], []
        for line in net.lines(answers, ids):
            spot = np.stack([a + line[a:b].argmax(0) for a, b in zip(starts, ends, strict=True)])
            spots.append(spot)
            tops.append(np.take_along_axis(line, spot, 0))
        pooled = np.concatenate(tops, axis=1) + net.bias
        off = ((sigmoid(net.logits(pooled)) - toxic) / len(toxic)).astype(np.float32)
        back = off[:, None] * net.out * (pooled > 0)
        to_vectors = np.zeros_like(vectors)
        for k, (w, spot) in enumerate(zip(s.widths, spots, strict=True)):
            part = back[:, k * s.filters : (k + 1) * s.filters]
            grad = np.zeros_like(net.kernel[k])
            for j in range(w):
                rows = ids[spot + j]
                grad[j] = np.einsum("nf,nfd->df", part, vectors[rows])
                np.add.at(to_vectors, rows.ravel(), (part[:, :, None] * net.kernel[k][j].T).reshape(-1, s.dim))
            adagrad.step(f"kernel{k}", net.kernel[k], grad)
        adagrad.step("out", net.out, np.maximum(pooled, 0).T @ off)
        adagrad.step("bias", net.bias, back.sum(0))
        self.small["base"] -= s.rate * off.sum()
        net.base = float(self.small["base"][0])
        hit = np.flatnonzero(np.abs(to_vectors).sum(1))
        each = np.repeat(to_vectors[hit] / n_buckets(grid[hit])[:, None], WIDTH, axis=0)
        touched, where = np.unique(grid[hit].ravel(), return_inverse=True)
        to_table = np.zeros((len(touched), s.dim), np.float32)
        np.add.at(to_table, where, each)
        to_table[touched == 0] = 0
        adagrad.step("table", net.table, to_table, touched)

    def values(self) -> np.ndarray:
        """All that is learned, and beside it what Adagrad has seen, as rows of `dim` numbers each: the table's, then the
        others'."""
        both = [self.net.table, *self.small.values()], [self.adagrad.seen[x] for x in ("table", *self.small)]
        flat = np.stack([np.concatenate([x.ravel() for x in part]) for part in both])
        dim = self.net.settings.dim
        flat = np.pad(flat, ((0, 0), (0, -flat.shape[1] % dim)))
        return flat.reshape(2, -1, dim).transpose(1, 0, 2).reshape(-1, 2 * dim)

    def add(self, rows: np.ndarray, changes: np.ndarray) -> None:
        """Change these rows of `values`."""
        dim = self.net.settings.dim
        values = self.values()
        values[rows] += changes.astype(np.float32)
        flat, at = values.reshape(-1, 2, dim).transpose(1, 0, 2).reshape(2, -1), 0
        for name, own in [("table", self.net.table), *self.small.items()]:
            for to, line in zip((own, self.adagrad.seen[name]), flat, strict=True):
                to[...] = line[at : at + own.size].reshape(own.shape)
            at += own.size
        self.net.base = float(self.small["base"][0])


def by_block(batches: Iterator[pd.DataFrame], s: Settings) -> Iterator[tuple[int, list[list[str]], np.ndarray]]:
    """Rows (block, toxic, text) that follow each other, as batches (block, words of the texts, toxic) of one block."""
    block, texts, toxic, n = -1, [], [], 0
    for rows in batches:
        for own, label, text in zip(rows["block"].tolist(), rows["toxic"].tolist(), rows["text"], strict=True):
            if texts and (own != block or len(texts) == s.batch or n > 1 << 18):
                yield block, texts, np.array(toxic, np.float32)
                texts, toxic, n = [], [], 0
            block = own
            texts.append(words_of(text))
            toxic.append(label)
            n += len(texts[-1])
    if texts:
        yield block, texts, np.array(toxic, np.float32)


def train(rows: DataFrame, odds: np.ndarray, s: Settings, passes: int) -> Network:
    """Descend over all `rows` (block, toxic, text), `passes` times. Each block starts from the network so far; what it
    sends on are the rows that it has changed, of one size whatever the block's, and their means over the blocks that changed
    them, by numbers of texts, are what the network changes by."""
    state, context = Training(first_network(odds, s)), rows.sparkSession.sparkContext
    columns = [f"v{k}" for k in range(2 * s.dim)]
    schema = ", ".join(["row int", "weight double", *(f"{c} float" for c in columns)])
    for _ in range(passes):
        sent, token = context.broadcast(state), uuid.uuid4().hex

        def run(batches: Iterator[pd.DataFrame], sent=sent, token=token) -> Iterator[pd.DataFrame]:
            before, numbered = sent.value.values(), in_worker(token, lambda: Numbered(s.buckets))
            for _, own in groupby(by_block(batches, s), key=itemgetter(0)):
                state, n = copy.deepcopy(sent.value), 0
                for _, texts, toxic in own:
                    state.batch(texts, toxic, numbered)
                    n += len(texts)
                change = state.values() - before
                met = np.flatnonzero(np.abs(change).sum(1))
                out = pd.DataFrame(change[met], columns=columns)
                out.insert(0, "row", met.astype(np.int32))
                out.insert(1, "weight", float(n))
                yield out

        sums = rows.select("block", "toxic", "text").mapInPandas(run, schema).groupBy("row")
        means = [(F.sum(F.col(c) * F.col("weight")) / F.sum("weight")).alias(c) for c in columns]
        found = sums.agg(*means).toPandas()  # no more rows than the network has
        state.add(found["row"].to_numpy(), found[columns].to_numpy(np.float64))
        sent.unpersist()
    return state.net


def best_bin(low: np.ndarray, high: np.ndarray, right: np.ndarray, wrong: np.ndarray) -> float:
    """The logit that gives the best F1 when everything at or above it is rejected; the middle of a gap. Of each bin of
    logits: the least and the largest, and the weights of its toxic and its clean rows."""
    order = np.argsort(-low, kind="stable")
    low, high, hit = low[order], high[order], np.cumsum(right[order])
    f1 = 2 * hit / (hit + np.cumsum(wrong[order]) + hit[-1])
    k = int(f1.argmax())
    return float((low[k] + high[k + 1]) / 2 if k + 1 < len(low) else low[k] - 1e-6)


def best_cut(z: np.ndarray, toxic: np.ndarray, weight: np.ndarray) -> float:
    """`best_bin` of single logits."""
    own, where = np.unique(z, return_inverse=True)
    right, wrong = (np.bincount(where, weight * (toxic > 0 if k else toxic <= 0), len(own)) for k in (1, 0))
    return best_bin(own, own, right, wrong)


@dataclass
class Model:
    """A network whose 0.5 is the calibrated cut over all languages, and the cut of each language as a score."""

    network: Network
    thresholds: dict[str, float]
    constant: float | None = None


#: Bins of logits to one unit when cuts are sought: a cut is the best border of bins, 0.00025 of the score apart at 0.5.
BINS = 1024
LOGITS = 36  # beyond, sigmoid can't tell them apart


def calibrated(net: Network, found: DataFrame, share: dict[int, float]) -> Model:
    """Cuts from all rows of `found` (z, lang, toxic), weighed so that both labels count as they do among all labels. Bins
    of logits are counted by Spark; the driver gets the bins over all languages and one cut a language."""
    z = F.greatest(F.lit(-float(LOGITS)), F.least(F.lit(float(LOGITS)), F.col("z")))
    binned = found.select("lang", "toxic", z.alias("z")).groupBy("lang", F.floor(F.col("z") * BINS).alias("bin"))
    binned = binned.agg(F.min("z").alias("low"), F.max("z").alias("high"), F.sum("toxic").alias("n1"), F.count_if(F.col("toxic") == 0).alias("n0"))
    binned = keep_table(binned, "logits")

    def cut_of(bins: pd.DataFrame) -> float:
        low, high, n1, n0 = (bins[c].to_numpy(np.float64) for c in ("low", "high", "n1", "n0"))
        return best_bin(low, high, n1 * share[1], n0 * share[0])

    def cut_of_language(bins: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"lang": [bins["lang"].iloc[0]], "cut": [cut_of(bins)]})

    whole = binned.groupBy("bin").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.sum("n1").alias("n1"), F.sum("n0").alias("n0"))
    cut = cut_of(whole.toPandas())
    net.base -= cut
    enough = binned.groupBy("lang").agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0")).where("n1 >= 20 AND n0 >= 20")
    own = binned.join(enough.select("lang"), "lang", "left_semi")  # no row without a language
    cuts = own.groupBy("lang").applyInPandas(cut_of_language, "lang string, cut double").collect()
    return Model(net, {r["lang"]: float(sigmoid(r["cut"] - cut)) for r in cuts})


def _labelled(docs: DataFrame, labels: DataFrame, key: str, text: str, lang: str, label: str, folds: int) -> tuple[DataFrame, DataFrame]:
    """(id, text, lang) of the rows with an id and a text, and (id, toxic, held, n) of the training labels that such rows
    have: whether they calibrate, and how many rows."""
    rows = docs.select(col(key).alias("id"), col(text).cast("string").alias("text"), col(lang).cast("string").alias("lang"))
    rows = rows.where("id IS NOT NULL AND text IS NOT NULL")
    given = (
        labels.where(col(label).isNotNull()).groupBy(col(key).alias("id")).agg((F.max(col(label).cast("int")) > 0).cast("int").alias("toxic"))
        .where(remainder(F.col("id"), folds) != 0)
    )
    held = (F.xxhash64("id", F.lit(1)) % 5 == 0).alias("held")
    known = given.join(rows.groupBy("id").agg(F.count("*").alias("n")), "id").select("id", "toxic", held, "n")
    return rows, keep_table(known, "labels")


def learn(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang",
          label: str = "toxic", folds: int = 5, settings: Settings = Settings()) -> Model:
    """Learn from all labelled rows whose crc32(key as text) mod `folds` isn't 0, each text whole. A row labelled twice is
    toxic if either label says so; of rows that repeat an id, the least text is taken; rows without key, label or text teach
    nothing. Without both labels (empty tables included) the score is a constant: 0 where nothing toxic is known, 1 where all
    is. Other columns are never looked at. What reaches the driver has the size of the model, whatever the input."""
    spark, s = docs.sparkSession, settings
    prepare(spark)
    rows, given = _labelled(docs, labels, key, text, lang, label, folds)
    counts = {(r["held"], r["toxic"]): r["count"] for r in given.groupBy("held", "toxic").count().collect()}
    totals = {k: counts.get((True, k), 0) + counts.get((False, k), 0) for k in (0, 1)}
    if not all(totals.values()):
        return Model(Network.new(s), {}, float(totals[1] > 0))
    apart = len(counts) == 4  # else all rows train and calibrate
    trained = {k: counts[False, k] if apart else totals[k] for k in (0, 1)}

    # Blocks of training rows come first, then those that calibrate.
    n = min(s.blocks, -(-sum(trained.values()) // s.train_rows))
    n_held = max(1, n // 4) if apart else 0
    place = F.xxhash64("id", F.lit(2))
    block = F.when(F.col("held") & F.lit(apart), n + F.pmod(place, F.lit(max(1, n_held)))).otherwise(F.pmod(place, F.lit(n)))
    met = rows.join(given.withColumn("block", block.cast("int")), "id")
    once = met.where("n = 1").select("id", "block", "toxic", "text", "lang")
    least = met.where("n > 1").groupBy("id", "block", "toxic").agg(F.min(F.struct("text", "lang")).alias("one"))
    dealt = once.union(least.select("id", "block", "toxic", "one.text", "one.lang")).repartitionById(n + n_held, "block")
    sample = keep_table(dealt.sortWithinPartitions("block", F.xxhash64("id", F.lit(3)), "id"), "labelled")
    training, check = (sample.where(F.col("block") < n), sample.where(F.col("block") >= n)) if apart else (sample, sample)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen, numbered = np.zeros((2, s.buckets), np.int64), Numbered(s.buckets)
        for batch in batches:
            for toxic, own in batch.groupby("toxic"):
                for part in chunks(own["text"], len, 1 << 20):
                    bucket_counts(seen[toxic], [words_of(t) for t in part], numbered)
        toxic, met = np.nonzero(seen)
        yield pd.DataFrame({"toxic": toxic, "bucket": met, "n": seen[toxic, met]})

    counted = training.select("toxic", "text").mapInPandas(count, "toxic int, bucket long, n long")
    counted = counted.groupBy("toxic", "bucket").agg(F.sum("n").alias("n")).toPandas()  # two rows a bucket at the most
    seen = np.zeros((2, s.buckets), np.int64)
    seen[counted["toxic"], counted["bucket"]] = counted["n"]
    odds = log_odds(seen, np.array([trained[0], trained[1]]))

    net = train(training, odds, s, max(min(s.passes, s.epochs), s.epochs // n))
    checked = check.select("lang", "toxic", _logit_column(check, net).alias("z"))
    share = {k: totals[k] / (counts[True, k] if apart else totals[k]) for k in (0, 1)}
    return calibrated(net, checked, share)


def _logit_column(docs: DataFrame, net: Network) -> Column:
    sent, token = docs.sparkSession.sparkContext.broadcast(net), uuid.uuid4().hex

    @F.pandas_udf("double")
    def logit(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = in_worker(token, lambda: Scorer(sent.value))
        for texts in batches:
            found = [scorer.logits(part) for part in chunks(texts, len, 1 << 20)]
            yield pd.Series(np.concatenate(found).astype(np.float64) if found else np.zeros(0))

    return logit(col("text"))


def score_column(docs: DataFrame, model: Model, text: str = "text") -> Column:
    """The score of each text, 0 to 1. Null counts as empty, and empty texts have a score. A very long text is read whole,
    in memory that follows its length."""
    spark = docs.sparkSession
    prepare(spark)
    sent, token = spark.sparkContext.broadcast(model), uuid.uuid4().hex

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = sent.value
        scorer = in_worker(token, lambda: Scorer(model.network))
        for texts in batches:
            if model.constant is not None:
                yield pd.Series(np.full(len(texts), model.constant))
                continue
            found = [scorer(part) for part in chunks(texts, len, 1 << 20)]
            yield pd.Series(np.concatenate(found) if found else np.zeros(0))

    return score(text_of(text))


def threshold_column(model: Model, lang: str = "lang") -> Column:
    """The cut of the row's language; 0.5 for languages with too few calibration rows and for null."""
    found = F.lit(0.5)
    for name, cut in sorted(model.thresholds.items()):
        found = F.when(col(lang) == name, F.lit(cut)).otherwise(found)
    return found


def with_toxicity(docs: DataFrame, model: Model, text: str = "text", lang: str = "lang") -> DataFrame:
    """All rows and columns of `docs`, with score, predicted (1 at 0.5 and above), threshold of the language, and toxic
    (score at or above it). Columns of these names are replaced. Repeated rows are scored each; an empty table stays
    empty."""
    name = free_name(docs, "tox_score")
    scored = docs.withColumn(name, score_column(docs, model, text)).withColumn("threshold", threshold_column(model, lang))
    return (
        scored.withColumn("score", col(name)).drop(name)
        .withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
        .withColumn("toxic", F.col("score") >= F.col("threshold"))
    )


def without_toxic(docs: DataFrame, model: Model, text: str = "text", lang: str = "lang") -> DataFrame:
    """The rows of `docs` whose score stays below the cut of their language; columns unchanged. Rows that repeat stay or go
    together if their languages agree; null texts count as empty; an empty table stays empty."""
    name = free_name(docs, "tox_score")
    scored = docs.withColumn(name, score_column(docs, model, text))
    return scored.where(col(name) < threshold_column(model, lang)).drop(name)
