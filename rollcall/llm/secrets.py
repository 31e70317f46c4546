"""Secrets by a trigram inverted index, with DataFrame functions only.

Each rule is a regular expression. A Boolean trigram query is derived from it: an OR of ANDs of three-letter strings that
every match holds, read off the literal runs of its parsed form. The index holds the postings of all trigrams that some
rule asks for: rows (trigram, document). A rule's postings are intersected to find its candidates, and only candidates
are verified with its expression. Rules without a mandatory trigram (hex runs) scan every text.

Candidates come back to the texts by document id. When there are at most `broadcast_rows` of them, after counting, they
are broadcast and no text is shuffled; beyond that they are joined by id. A document id that repeats makes all its rows
candidates, and rows without an id are candidates of every rule: verification decides.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.llm.common import col, free_name, is_small, keep_table, text_of

SPANS = "array<struct<start:int,end:int>>"
_PARSE = re._parser.parse
#: Variants of literal runs that are told apart at most; a pattern with more of them breaks its runs instead.
VARIANTS = 64


@dataclass(frozen=True)
class Rule:
    """A kind of secret. A match of `regex` counts if its `group` (0: all of it) has `least` code points or more."""

    kind: str
    regex: str
    least: int = 0
    group: int = 0
    any_case: bool = False

    @property
    def java(self) -> str:
        return "(?i)" + self.regex if self.any_case else self.regex

    @property
    def query(self) -> list[frozenset[str]]:
        return trigram_query(self.regex)


# The base kinds. Where a kind's length counts for the whole match, its expression counts: the runs of letters
# are as long as they can be, so a match that would be too short is none, and no shorter one begins inside of it. The value
# of an assignment is measured afterwards, because one that is too short still uses up its text.
BASE = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, 2, True),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"(?<![0-9a-f])[0-9a-f]{24,}"),
)
ADDED = (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("hub_token", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat_token", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"),
    Rule("map_key", r"AIza[A-Za-z0-9_-]{35,}"),
)
RULES = BASE + ADDED


# Trigram queries -----------------------------------------------------------------------------------------------------


def _runs(parsed: Iterable) -> set[str]:
    """What every match is made of: literal runs, with a NUL wherever something unknown stands between them. One string
    for each way through the pattern's branches and optional parts."""
    ways = {""}
    for op, value in parsed:
        name = str(op)
        if name == "LITERAL":
            part = {chr(value)}
        elif name == "SUBPATTERN":
            part = _runs(value[3])
        elif name == "BRANCH":
            part = set().union(*(_runs(p) for p in value[1]))
        elif name == "MAX_REPEAT" and value[1] == 1:
            part = _runs(value[2]) | {""}
        elif name == "MAX_REPEAT" and value[0] > 0:
            part = {f"{r}\0" for r in _runs(value[2])}
        elif name == "AT":
            part = {""}
        else:
            part = {"\0"}
        if len(ways) * len(part) > VARIANTS:
            part = {"\0"}
        ways = {a + b for a in ways for b in part}
    return ways


def trigram_query(regex: str) -> list[frozenset[str]]:
    """Sets of lower-case trigrams: every match holds all of at least one set. Empty if nothing is mandatory."""
    sets = {
        frozenset(run[i : i + 3] for run in way.lower().split("\0") for i in range(len(run) - 2))
        for way in _runs(_PARSE(regex))
    }
    if frozenset() in sets:
        return []
    return sorted((s for s in sets if not any(other < s for other in sets)), key=sorted)


def postings(docs: DataFrame, trigrams: list[str], key: str, text: str) -> DataFrame:
    """The index: a row (trigram, id) for each of the trigrams that a document's text holds in either case."""
    low = docs.select(col(key).alias("id"), F.lower(text_of(text)).alias("low")).where("id is not null")
    found = F.array(*[F.when(F.contains("low", F.lit(t)), F.lit(t)) for t in trigrams])
    return low.select(F.explode(F.array_compact(found)).alias("trigram"), "id")


def candidates(index: DataFrame, rules: list[Rule]) -> DataFrame:
    """Postings intersected: (id, rules), the names of the rules whose query the document meets. The trigrams of a
    document are a bit set, gathered on the map side; a set of trigrams is met when all its bits are there."""
    names = sorted({t for r in rules for s in r.query for t in s})
    # 62 bits a word
    words = range(-(-len(names) // 62))
    bit = {t: (i // 62, 1 << (i % 62)) for i, t in enumerate(names)}
    has = [
        F.bit_or(
            F.coalesce(*[F.when(F.col("trigram") == t, F.lit(b)) for t, (w, b) in bit.items() if w == k], F.lit(0))
        ).alias(f"bits{k}")
        for k in words
    ]
    sets = index.groupBy("id").agg(*has)

    def met(one: frozenset[str]) -> Column:
        out = F.lit(True)
        for k in words:
            need = sum(bit[t][1] for t in one if bit[t][0] == k)
            if need:
                out = out & (F.col(f"bits{k}").bitwiseAND(F.lit(need)) == need)
        return out

    def any_met(rule: Rule) -> Column:
        out = F.lit(False)
        for one in rule.query:
            out = out | met(one)
        return out

    met_rules = F.array_compact(F.array(*[F.when(any_met(r), F.lit(r.kind)) for r in rules]))
    return sets.select("id", met_rules.alias("rules")).where(F.size("rules") > 0)


# Verification ---------------------------------------------------------------------------------------------------------


#: Spans that are put together at once; the blocks of a text are joined at the end.
BLOCK = 256


def matches(text: Column, rule: Rule) -> Column:
    """The spans of a rule's leftmost, non-overlapping matches that are long enough; code points, end exclusive.

    What stands between the matches comes from splitting at them, so a match begins where the pieces and matches before
    it end. Only lengths are kept of both. Spans are gathered in blocks, so that adding one copies a block at the most and
    not all spans before it."""
    regex = F.lit(rule.java)
    gaps = F.transform(F.split(text, rule.java, -1), F.length)
    hits = F.transform(F.regexp_extract_all(text, regex, 0), F.length)
    columns = [gaps.alias("gap"), hits.alias("hit")]
    if rule.group:
        columns.append(F.transform(F.regexp_extract_all(text, regex, rule.group), F.length).alias("measured"))
    measured = "measured" if rule.group else "hit"
    # the last piece follows the last match
    lengths = F.filter(F.arrays_zip(*columns), lambda r: r["hit"].isNotNull())
    empty = F.array().cast(SPANS)

    def step(state: Column, r: Column) -> Column:
        first = state["at"] + r["gap"]
        end = first + r["hit"]
        one = F.array(F.struct(first.alias("start"), end.alias("end")))
        added = F.when(r[measured] >= rule.least, F.concat(state["out"], one)).otherwise(state["out"])
        return F.struct(end.alias("at"), added.alias("out"))

    def block(state: Column, rows: Column) -> Column:
        done = F.aggregate(rows, F.struct(state["at"].alias("at"), empty.alias("out")), step)
        return F.struct(done["at"].alias("at"), F.concat(state["out"], F.array(done["out"])).alias("out"))

    def cut(rows: Column) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.size(rows), F.lit(1)), F.lit(BLOCK))
        return F.transform(starts, lambda at: F.slice(rows, at, BLOCK))

    start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{SPANS}>").alias("out"))
    # as the element of an array the lengths are worked out once, and not for each block
    found = F.transform(F.array(lengths), lambda rows: F.flatten(F.aggregate(cut(rows), start, block, lambda s: s["out"])))[0]
    return F.when(text.rlike(rule.java), found).otherwise(empty)


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES, key: str = "doc_id", text: str = "text",
         broadcast_rows: int = 1_000_000) -> DataFrame:
    """All rows and columns of `docs` with a column found: a struct with the spans of each rule by its kind.

    Null and empty texts have no spans; rows that repeat each get theirs; an empty table gives none. A column found of
    `docs` is replaced, others stay. A very long text is scanned whole; beside it, memory follows the number of its matches.
    """
    asked = [r for r in rules if r.query]
    names = sorted({t for r in asked for s in r.query for t in s})
    name, rules_of = free_name(docs, "cand_id"), free_name(docs, "cand_rules")
    source = docs
    if asked:
        index = keep_table(postings(docs, names, key, text), "postings")
        chosen = keep_table(candidates(index, asked), "candidates")
        few = is_small(chosen, broadcast_rows)
        chosen = chosen.select(F.col("id").alias(name), F.col("rules").alias(rules_of))
        source = docs.join(F.broadcast(chosen) if few else chosen, col(key) == col(name), "left")
    body = text_of(text)

    def of(rule: Rule) -> Column:
        if rule not in asked:
            return matches(body, rule)
        wanted = col(key).isNull() | F.coalesce(F.array_contains(col(rules_of), rule.kind), F.lit(False))
        return F.when(wanted, matches(body, rule)).otherwise(F.array().cast(SPANS))

    found = F.struct(*[of(r).alias(r.kind) for r in rules])
    return source.select(*[col(c) for c in docs.columns if c.lower() != "found"], found.alias("found"))


def joined_spans(found: Column, rules: tuple[Rule, ...]) -> Column:
    """kind:start:end of all spans of the rules, by start, then by the rules' order, joined by commas."""

    def placed(n: int, kind: str) -> Column:
        name = F.lit(kind).alias("kind")
        return F.transform(
            found[kind],
            lambda s: F.struct(s["start"].alias("start"), F.lit(n).alias("n"), s["end"].alias("end"), name),
        )

    rows = F.array_sort(F.flatten(F.array(*[placed(n, r.kind) for n, r in enumerate(rules)])))
    return F.array_join(F.transform(rows, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
