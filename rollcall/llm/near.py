"""Near duplicates by a chosen-path set similarity join over minwise tokens.

Documents with the same shingle set are one class from the start. Each class has a signature of minwise tokens. A tree
branches classes by tokens: a node chooses, by hashing its own path, some coordinates of the signature, and a class goes
on to the child that its tokens at these coordinates name. Similar classes share tokens, so they stay together along some
path. Small nodes are compared exhaustively; large ones branch again, by as many tokens at once as their size asks for
and along as many independent paths as make up for the pairs that a longer path loses. Independent trees bring the
recall up to `recall`.

Comparison is in two steps. Within a node, signatures are compared and classes whose estimate comes near the threshold
form a cluster; clusters met in several trees are kept once. Then the full shingle sets of a cluster's classes are
brought together and compared exactly; a cluster gives links that span its linked classes, never all pairs. Of a cluster
of more than `leaf_shingles` shingles, slices of the shingles by value are brought together instead, and what its classes
share in each slice is added up.

A large family of near copies stays together along every path, so large nodes are settled before they branch: each class
is compared with the nearest of a few pivots of its node, links found so are confirmed, and in each node the component
with the most classes counts as settled. What is settled needn't be compared among itself again. The other classes of a
node meet all, in blocks, as soon as that makes fewer copies than branching, and in any case after `depth` rounds: nothing
is lost to a bound, and a family of n copies costs about n.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollcall.llm.common import WordHashes, chunks, col, free_name, in_worker, is_small, keep_table, mix, prepare, text_of
from rollcall.llm.components import components


@dataclass(frozen=True)
class Settings:
    shingle: int = 5
    percent: int = 85  # of the union that the intersection must reach
    tokens: int = 96  # of a signature
    recall: float = 0.99995
    leaf: int = 4096  # classes of a node that are compared exhaustively
    leaf_shingles: int = 4_000_000  # and the shingles of them all, unless there are few classes; those compared at once
    depth: int = 4
    pivots: int = 8  # of a large node, on average
    chunk: int = 64  # classes that are compared with their pivot at once
    broadcast_rows: int = 1_000_000

    @property
    def similarity(self) -> float:
        return self.percent / 100

    @property
    def trees(self) -> int:
        """So many that a pair at the threshold is lost by all with probability 1 - recall. In one tree it is kept by the
        first token, and, should its nodes be large, by `depth` further rounds that keep 93 of 100."""
        return math.ceil(math.log(1 - self.recall) / math.log(1 - self.similarity * 0.93**self.depth))

    @property
    def near(self) -> float:
        """The share of equal tokens from which a pair is compared exactly: four standard errors below the threshold."""
        s = self.similarity
        return s - 4 * math.sqrt(s * (1 - s) / self.tokens)


# Shingles and signatures ---------------------------------------------------------------------------------------------

#: Odd multipliers.
_FACTORS = mix(np.arange(101, 106, dtype=np.uint64)) | np.uint64(1)
#: What sets the words of a shingle apart by their places.
_ADDED = mix(np.arange(1, 65, dtype=np.uint64))


def shingle_sets(texts: list[str], hashes: WordHashes, n: int) -> list[np.ndarray]:
    """The sorted distinct 64-bit hashes of each text's n-word shingles; of a shorter text, of all its words."""
    words = [t.encode().lower().split() for t in texts]
    flat = hashes([w for part in words for w in part])
    whole = np.zeros(max(0, len(flat) - n + 1), np.uint64)
    for j in range(n):
        whole += mix(flat[j : len(flat) - n + 1 + j] + _ADDED[j]) if len(whole) else whole
    whole = mix(whole)
    out, at = [], 0
    for part in words:
        k = len(part)
        if k >= n:
            out.append(np.unique(whole[at : at + k - n + 1]))
        elif k:
            short = flat[at : at + k] * _FACTORS[:k] + np.uint64(k)
            out.append(mix(mix(short).sum(keepdims=True)))
        else:
            out.append(np.zeros(0, np.uint64))
        at += k
    return out


def signatures(sets: list[np.ndarray], tokens: int) -> np.ndarray:
    """For each set and coordinate the upper 32 bits of the smallest hash; sets mustn't be empty."""
    rng = np.random.default_rng(5)
    add = rng.integers(0, 1 << 63, tokens, np.uint64)
    flat = np.concatenate(sets)
    starts = np.cumsum([0, *map(len, sets[:-1])])
    out = np.zeros((len(sets), tokens), np.uint32)
    for k in range(tokens):
        moved = (flat ^ add[k]) * _FACTORS[k % 5]
        moved ^= moved >> np.uint64(32)
        moved *= _FACTORS[(k + 2) % 5]
        out[:, k] = np.minimum.reduceat(moved, starts) >> np.uint64(32)
    return out


def _sets_of(rows: DataFrame, s: Settings) -> DataFrame:
    """(id, n, key1, key2, signature): the size of each text's set, 128 bits that stand for it, and its minwise tokens
    of 32 bits, packed; empty sets have no signature."""
    kind, token = rows.schema["id"].dataType.simpleString(), uuid.uuid4().hex

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = in_worker(token, WordHashes)
        for batch in batches:
            ids = batch["id"].tolist()
            at = 0
            for part in chunks(batch["text"], len, 1 << 20):
                sets = shingle_sets(part, hashes, s.shingle)
                keys = [(int(x.sum().view(np.int64)), int(mix(x ^ _FACTORS[1]).sum().view(np.int64))) for x in sets]
                full = [k for k, x in enumerate(sets) if len(x)]
                signed = signatures([sets[k] for k in full], s.tokens) if full else []
                rows: list = [None] * len(sets)
                for k, row in zip(full, signed, strict=True):
                    rows[k] = row.tobytes()
                yield pd.DataFrame({
                    "id": ids[at : at + len(part)], "n": list(map(len, sets)), "key1": [k[0] for k in keys],
                    "key2": [k[1] for k in keys], "signature": pd.Series(rows, dtype=object),
                })
                at += len(part)

    return rows.mapInPandas(run, f"id {kind}, n long, key1 long, key2 long, signature binary")


# Trees ---------------------------------------------------------------------------------------------------------------


def _token(signature: Column, coordinate: Column) -> Column:
    return F.substring(signature, (coordinate * 4 + 1).cast("int"), F.lit(4))


def _child(node: Column, branch: Column, tokens: Column, signature: Column, s: Settings) -> Column:
    """The child that a class goes on to: named by the node, the branch, and the class's tokens at coordinates that the
    node chooses."""
    named = F.transform(
        F.sequence(F.lit(1), tokens), lambda j: _token(signature, F.pmod(F.xxhash64(node, branch, j), F.lit(s.tokens)))
    )
    return F.xxhash64(node, branch, named)


def _steps(size: Column, s: Settings) -> tuple[Column, Column]:
    """Tokens taken at once in a large node, and paths: dissimilar classes share a token in 6 of 10 cases at the most
    (they share a passage), and 93 of 100 pairs at the threshold keep together on one of the paths."""
    tokens = F.least(F.lit(8), F.greatest(F.lit(1), F.ceil(F.log(size / F.lit(s.leaf)) / math.log(1 / 0.6)))).cast("int")
    kept = F.pow(F.lit(s.similarity), tokens)
    paths = F.ceil(F.lit(math.log(1 - 0.93)) / F.log(1 - kept)).cast("int")
    return tokens, paths


def _leaves(classes: DataFrame, texts: DataFrame, s: Settings) -> tuple[DataFrame, DataFrame | None]:
    """(node, left, right): for every node to compare, its classes as arrays of (rep, signature). Where there is a right
    side, the left one meets it; else each class meets each. And, where nodes were large, (id, component) of the classes
    that were settled first."""
    slim = classes.select("rep", "n", "signature")
    branch = F.explode(F.sequence(F.lit(0), F.lit(s.trees - 1))).alias("tree")
    frontier = (
        slim.select("rep", "n", "signature", branch)
        .select("rep", "n", F.xxhash64("tree", _token(F.col("signature"), F.col("tree"))).alias("node"))
    )
    found, settled = [], None
    for level in range(s.depth + 1):
        frontier = keep_table(frontier, f"frontier{level}")
        nodes = frontier.groupBy("node").agg(F.count("*").alias("size"), F.sum("n").alias("shingles"))
        small = (F.col("size") <= s.leaf) & ((F.col("shingles") <= s.leaf_shingles) | (F.col("size") <= 8))
        placed = frontier.join(nodes.where("size > 1").withColumn("small", small), "node")
        placed = keep_table(placed.join(slim.select("rep", "signature"), "rep"), f"placed{level}")
        member = F.struct("rep", "signature")
        none = F.array().cast("array<struct<rep:{0},signature:binary>>".format(slim.schema["rep"].dataType.simpleString()))
        found.append(
            placed.where("small").groupBy("node").agg(F.collect_list(member).alias("left")).withColumn("right", none)
        )
        large = placed.where("not small")
        if large.isEmpty():
            break
        if settled is None:
            stars = keep_table(_links(_stars(large, s), classes, texts, s), "star_links")
            settled = keep_table(components(stars), "settled")
        tokens, paths = _steps(F.col("size"), s)
        opened, rest = _opened(large, settled, paths, level == s.depth, s)
        found.append(_blocks(opened, member))
        if level == s.depth:
            break
        spread = rest.withColumn("branch", F.explode(F.sequence(F.lit(1), paths)))
        child = _child(F.col("node"), F.col("branch"), tokens, F.col("signature"), s)
        frontier = spread.select("rep", "n", child.alias("node"))
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out, settled


def _stars(large: DataFrame, s: Settings) -> DataFrame:
    """(cluster, rep): each class of a large node with the pivot that its signature is nearest to, if that comes near the
    threshold, in chunks; and the pivots of a node together. Pivots are picked by hash, about `pivots` a node."""
    picked = F.pmod(F.xxhash64("rep", F.lit(1)), F.ceil(F.col("size") / s.pivots)) == 0
    pivots = large.where(picked).select("node", F.col("rep").alias("pivot"), F.col("signature").alias("mark"))
    pivots = keep_table(pivots, "pivots")
    few = is_small(pivots, s.broadcast_rows)
    # A join on the node that no grouping by node follows: adaptive execution splits a very large node.
    pairs = large.join(F.broadcast(pivots) if few else pivots, "node").where("rep <> pivot")
    kind = large.schema["rep"].dataType.simpleString()

    def compared(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                one, other = (np.frombuffer(b"".join(batch[c]), np.uint32).reshape(-1, s.tokens) for c in ("signature", "mark"))
                same = np.count_nonzero(one == other, axis=1)
                yield batch[["rep", "pivot"]].assign(same=same.astype(np.int32))[same >= s.near * s.tokens]

    near = pairs.select("rep", "pivot", "signature", "mark").mapInPandas(compared, f"rep {kind}, pivot {kind}, same int")
    nearest = keep_table(near.groupBy("rep").agg(F.max_by("pivot", F.struct("same", "pivot")).alias("pivot")), "nearest")
    counted = nearest.groupBy("pivot").agg(F.ceil(F.count("*") / F.lit(s.chunk)).alias("chunks"))
    chunk = F.pmod(F.xxhash64("rep", F.lit(2)), F.col("chunks"))
    rays = nearest.join(counted, "pivot").select(F.xxhash64("pivot", chunk).alias("cluster"), "rep", "pivot")
    centres = rays.select("cluster", F.col("pivot").alias("rep"))
    together = pivots.select(F.xxhash64("node", F.lit("pivots")).alias("cluster"), F.col("pivot").alias("rep"))
    return keep_table(rays.select("cluster", "rep").unionByName(centres).unionByName(together).distinct(), "stars")


def _opened(large: DataFrame, settled: DataFrame, most: Column, last: bool, s: Settings) -> tuple[DataFrame, DataFrame]:
    """The nodes to compare in blocks, with the block of each class, and the nodes that branch. `others` and `same` are the
    numbers of blocks of a node's other and settled classes; nodes whose classes are all settled are in neither. A node is
    opened if its other classes take `most` blocks or fewer, or if it can't branch any more (`last`)."""
    homes = settled.select(F.col("id").alias("rep"), "component")
    homed = large.join(homes, "rep", "left").withColumn("home", F.coalesce("component", "rep")).drop("component")
    homed = keep_table(homed, "homed")
    counted = homed.groupBy("node", "home").agg(F.count("*").alias("rows"))
    mains = counted.groupBy("node").agg(F.max_by("home", F.struct("rows", "home")).alias("main"), F.max("rows").alias("most"))
    half = F.lit(max(1, s.leaf // 2))
    others, same = F.ceil((F.col("size") - F.col("most")) / half).cast("int"), F.ceil(F.col("most") / half).cast("int")
    placed = homed.join(mains, "node").withColumns({"others": others, "same": same}).where("others > 0")
    fits = F.lit(last) | (F.col("others") <= most)
    mixed, is_main = F.xxhash64("rep", F.lit(3)), F.col("home") == F.col("main")
    block = F.when(is_main, F.col("others") + F.pmod(mixed, F.col("same"))).otherwise(F.pmod(mixed, F.col("others")))
    return placed.where(fits).withColumn("block", block.cast("int")), placed.where(~fits)


def _blocks(opened: DataFrame, member: Column) -> DataFrame:
    """The leaves of opened nodes: blocks of other classes meet themselves and all blocks, those of settled classes (the
    last `same`) only blocks of others."""
    last = F.when(F.col("block") < F.col("others"), F.col("others") + F.col("same")).otherwise(F.col("others")) - 1
    met = opened.withColumn("other", F.explode(F.sequence(F.lit(0), last)))
    sides = met.withColumns({"a": F.least("block", "other"), "b": F.greatest("block", "other")})
    left, right = F.when(F.col("block") == F.col("a"), member), F.when(F.col("block") != F.col("a"), member)
    return (
        sides.groupBy("node", "a", "b").agg(F.collect_list(left).alias("left"), F.collect_list(right).alias("right"))
        .where("a = b or (size(left) > 0 and size(right) > 0)")
        .select(F.xxhash64("node", "a", "b").alias("node"), "left", "right")
    )


def _joined(n: int, near: Iterator[tuple[int, np.ndarray]]) -> np.ndarray:
    """For each of n things the first of those that it is joined to, directly or through others. `near` gives a thing and
    those that it is joined to."""
    home = np.arange(n)
    for i, others in near:
        if len(others):
            met = np.unique(home[np.append(others, i)])
            if len(met) > 1:
                home[np.isin(home, met[1:])] = met[0]
    return home


def _near_rows(signed: np.ndarray, least: float, left: int) -> Iterator[tuple[int, np.ndarray]]:
    """For each row of signatures those after it that come near; with a right side, for each of the `left` first rows
    those on the right."""
    for i in range(min(left, len(signed) - 1)):
        after = i + 1 if left == len(signed) else left
        same = np.count_nonzero(signed[after:] == signed[i], axis=1)
        yield i, after + np.flatnonzero(same >= least * signed.shape[1])


def _clusters(leaves: DataFrame, s: Settings) -> DataFrame:
    """(cluster, rep): the classes of a node whose signatures chain together, under a name made of their ids."""
    import xxhash

    kind = leaves.schema["left"].dataType.elementType["rep"].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            names, reps = [], []
            for left, right in zip(batch["left"], batch["right"], strict=True):
                rows = [(m["rep"], m["signature"]) for m in [*left, *right]]
                if len(rows) < 2:
                    continue
                group: dict[int, list] = {}
                signed = np.stack([np.frombuffer(r[1], np.uint32) for r in rows])
                firsts = _joined(len(rows), _near_rows(signed, s.near, len(left))).tolist()
                for (rep, _), first in zip(rows, firsts, strict=True):
                    group.setdefault(first, []).append(rep)
                for members in group.values():
                    if len(members) > 1:
                        members.sort()
                        name = xxhash.xxh3_64_intdigest(repr(members).encode()) - (1 << 63)
                        names += [name] * len(members)
                        reps += members
            yield pd.DataFrame({"cluster": pd.Series(names, dtype="int64"), "rep": reps})

    return leaves.select("left", "right").mapInPandas(run, f"cluster long, rep {kind}").distinct()


# Exact comparison ----------------------------------------------------------------------------------------------------


def linked(sets: list[np.ndarray], percent: int) -> list[int]:
    """For each set the first one that it is linked to, directly or through others: 100 x intersection >= percent x
    union. Intersections of many sets are counted at once, as products of their incidence matrix, in slices; shingles that
    only one set has are left out, which in copies of one text are almost all that differ."""
    n, sizes = len(sets), np.array([len(x) for x in sets], np.int64)
    if n <= 12:
        shared = (np.array([len(np.intersect1d(sets[i], x, assume_unique=True)) for x in sets[i + 1 :]]) for i in range(n - 1))
    else:
        both = overlaps(sets)
        shared = (both[i, i + 1 :].astype(np.int64) for i in range(n - 1))
    return _joined(n, _enough(sizes, shared, percent)).tolist()


def _enough(sizes: np.ndarray, shared: Iterable[np.ndarray], percent: int) -> Iterator[tuple[int, np.ndarray]]:
    """For each set those after it that it is linked to; `shared` gives its intersections with them."""
    for i, both in enumerate(shared):
        yield i, i + 1 + np.flatnonzero(100 * both >= percent * (sizes[i] + sizes[i + 1 :] - both))


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """The sizes of all intersections of two of the sets."""
    n, sizes = len(sets), np.array([len(x) for x in sets], np.int64)
    _, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(n, dtype=np.int32), sizes)
    shared = times > 1
    kept = shared[column]
    number = np.cumsum(shared) - 1
    row, column = row[kept], number[column[kept]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    both = np.zeros((n, n), np.float32)
    width = max(64, (1 << 22) // n)
    for first in range(0, int(shared.sum()), width):
        a, b = np.searchsorted(column, [first, first + width])
        part = np.zeros((n, width), np.float32)
        part[row[a:b], column[a:b] - first] = 1
        both += part @ part.T  # whole numbers below 2^24, so exact
    return both


def _heavy_links(members: DataFrame, sets: DataFrame, s: Settings) -> DataFrame:
    """(a, b) as _links, for clusters whose sets are too much for one row. `members` (cluster, rep, n, slices) says in how
    many slices a cluster's shingles are compared; a row holds one slice of all its sets, about `leaf_shingles`."""
    kind = sets.schema["rep"].dataType.simpleString()
    of = Window.partitionBy("cluster")
    placed = members.withColumns({
        "i": F.row_number().over(of.orderBy("rep")) - 1,
        "size": F.count("*").over(of).cast("int"),
    })
    placed = keep_table(placed, "heavy_members")

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for cluster, i, size, slices, held in zip(*(batch[c] for c in batch), strict=True):
                flat = np.frombuffer(held, np.uint64)
                ends = [(k << 64) // slices for k in range(1, slices)]
                at = [0, *np.searchsorted(flat, np.array(ends, np.uint64)).tolist(), len(flat)]
                rows = [(cluster, k, size, i, flat[at[k] : at[k + 1]].tobytes()) for k in range(slices) if at[k] < at[k + 1]]
                yield pd.DataFrame(rows, columns=["cluster", "slice", "size", "i", "part"])

    parts = (
        placed.join(sets, "rep").select("cluster", "i", "size", "slices", "shingles")
        .mapInPandas(cut, "cluster long, slice int, size int, i int, part binary")
        .groupBy("cluster", "slice", "size").agg(F.collect_list(F.struct("i", "part")).alias("parts"))
    )

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for cluster, size, parts in zip(batch["cluster"], batch["size"], batch["parts"], strict=True):
                held = sorted(((m["i"], m["part"]) for m in parts), key=lambda m: m[0])
                at = np.array([m[0] for m in held])
                both = overlaps([np.frombuffer(m[1], np.uint64) for m in held])
                for some in np.array_split(np.arange(len(at)), math.ceil(len(at) / 256)):
                    rows = []
                    for k in some.tolist():
                        row = np.zeros(size, np.int32)
                        row[at] = both[k]
                        rows.append(row[at[k] + 1 :].tobytes())
                    yield pd.DataFrame({"cluster": cluster, "i": at[some], "counts": rows})

    shared = parts.select("cluster", "size", "parts").mapInPandas(counted, "cluster long, i int, counts binary")
    shared = shared.groupBy("cluster", "i").agg(F.collect_list("counts").alias("counts"))

    def added(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sums = []
            for counts in batch["counts"]:
                total = np.frombuffer(counts[0], np.int32).astype(np.int64)
                for more in counts[1:]:
                    total += np.frombuffer(more, np.int32)
                sums.append(total.astype(np.int32).tobytes())
            yield pd.DataFrame({"cluster": batch["cluster"], "i": batch["i"], "counts": pd.Series(sums, dtype=object)})

    whole = (
        shared.mapInPandas(added, "cluster long, i int, counts binary").join(placed, ["cluster", "i"])
        .groupBy("cluster").agg(F.collect_list(F.struct("i", "rep", "n", "counts")).alias("members"))
    )

    def compared(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            a, b = [], []
            for members in batch["members"]:
                rows = sorted(members, key=lambda m: m["i"])
                sizes = np.array([m["n"] for m in rows], np.int64)
                both = (np.frombuffer(m["counts"], np.int32).astype(np.int64) for m in rows)
                firsts = _joined(len(rows), _enough(sizes, both, s.percent)).tolist()
                for i, first in enumerate(firsts):
                    if i != first:
                        a.append(rows[first]["rep"])
                        b.append(rows[i]["rep"])
            yield pd.DataFrame({"a": a, "b": b})

    return whole.select("members").mapInPandas(compared, f"a {kind}, b {kind}")


def _links(clusters: DataFrame, classes: DataFrame, texts: DataFrame, s: Settings) -> DataFrame:
    """(a, b): links that span the linked classes of each cluster. `classes` (rep, n) has the sizes of the sets, `texts`
    (rep, text) holds one text a class."""
    sized = clusters.join(classes.select("rep", "n"), "rep")
    heavy = sized.groupBy("cluster").agg(F.ceil(F.sum("n") / F.lit(s.leaf_shingles)).cast("int").alias("slices"))
    heavy = keep_table(heavy.where("slices > 1"), "heavy_clusters")
    none_heavy = heavy.isEmpty()
    light = clusters if none_heavy else clusters.join(heavy, "cluster", "left_anti")
    reps = keep_table(clusters.select("rep").distinct(), "near_reps")
    few = is_small(reps, s.broadcast_rows)
    wanted = texts.join(F.broadcast(reps) if few else reps, "rep")
    kind, token = texts.schema["rep"].dataType.simpleString(), uuid.uuid4().hex

    def shingled(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = in_worker(token, WordHashes)
        for batch in batches:
            ids, at = batch["rep"].tolist(), 0
            for part in chunks(batch["text"], len, 1 << 20):
                sets = shingle_sets(part, hashes, s.shingle)
                yield pd.DataFrame({"rep": ids[at : at + len(part)], "shingles": [x.tobytes() for x in sets]})
                at += len(part)

    sets = wanted.mapInPandas(shingled, f"rep {kind}, shingles binary")
    members = F.collect_list(F.struct("rep", "shingles")).alias("members")
    grouped = light.join(sets, "rep").groupBy("cluster").agg(members)

    def compared(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            a, b = [], []
            for members in batch["members"]:
                rows = sorted(((m["rep"], m["shingles"]) for m in members), key=lambda r: r[0])
                firsts = linked([np.frombuffer(r[1], np.uint64) for r in rows], s.percent)
                for i, first in enumerate(firsts):
                    if i != first:
                        a.append(rows[first][0])
                        b.append(rows[i][0])
            yield pd.DataFrame({"a": a, "b": b})

    links = grouped.select("members").mapInPandas(compared, f"a {kind}, b {kind}")
    return links if none_heavy else links.unionByName(_heavy_links(sized.join(heavy, "cluster"), sets, s))


def near_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """One row a row of `docs`: its key, n_shingles (distinct ones), component_id (the smallest key that links lead to)
    and kept (it is that key).

    Words are runs of bytes other than ASCII white space, A-Z in lower case. Rows without words, null or empty, have no
    shingles, are linked with nothing and stay. Rows that repeat a key are one document: what one is linked with, all are.
    Rows without a key are linked with nothing: component_id is null and they stay. An empty table gives no rows; other
    columns are never looked at.
    """
    s = settings
    spark = docs.sparkSession
    prepare(spark)
    rows = docs.select(col(key).alias("id"), text_of(text).alias("text"))
    table = keep_table(_sets_of(rows, s), "signatures")
    full = table.where("n > 0 and id is not null")
    classes = keep_table(
        full.groupBy("key1", "key2", "n").agg(F.min("id").alias("rep"), F.first("signature").alias("signature")), "classes"
    )
    texts = rows.where("id is not null").withColumnRenamed("id", "rep")
    leaves, settled = _leaves(classes, texts, s)
    clusters = keep_table(_clusters(leaves, s), "clusters")
    links = _links(clusters, classes, texts, s)
    if settled is not None:
        links = links.unionByName(settled.select(F.col("component").alias("a"), F.col("id").alias("b")))
    found = components(keep_table(links, "links"))
    homes = classes.select("key1", "key2", "n", "rep").join(found, F.col("rep") == F.col("id"), "left")
    homes = homes.select("key1", "key2", "n", F.coalesce("component", "rep").alias("component"))
    placed = full.select("id", "key1", "key2", "n").join(homes, ["key1", "key2", "n"]).select("id", "n", "component")
    alone = table.where("n = 0 or id is null").select("id", "n", F.col("id").alias("component"))
    return placed.unionByName(alone).select(
        F.col("id").alias(key),
        F.col("n").alias("n_shingles"),
        F.col("component").alias("component_id"),
        F.col("id").eqNullSafe(F.col("component")).alias("kept"),
    )


def without_near_copies(
    docs: DataFrame, key: str = "doc_id", text: str = "text", settings: Settings = Settings()
) -> DataFrame:
    """The rows of `docs`, one document of each group: that of the smallest key. All columns stay. The keys that go are
    broadcast when they are few after counting, else joined."""
    name = free_name(docs, "copy_id")
    gone = near_groups(docs, key, text, settings).where("not kept").select(col(key).alias(name)).distinct()
    gone = keep_table(gone, "near_copies")
    few = is_small(gone, settings.broadcast_rows)
    return docs.join(F.broadcast(gone) if few else gone, col(key) == col(name), "left_anti")
