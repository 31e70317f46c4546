"""Personal data: patterns propose spans, checksums and ranges confirm them, words nearby adjust the score.

Base kinds: email, ip (four parts of at most 255), card (16 to 19 digits that pass Luhn), phone (+, 8 to 15 digits).
Added kind: iban (mod-97). Spans are code points, the end is exclusive; matches of a kind are leftmost and don't overlap,
and one that fails its check is dropped without another try. All scans are linear in the length of the text.

A span's score is its kind's, raised by a word of the kind in the 40 characters before it or 20 after it, lowered by
words of numbers that aren't personal (order, invoice, version ...). Scores never drop a span here: the caller sets
`least_score`.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from rollcall.llm.common import prepare

KINDS = ("email", "ip", "card", "phone", "iban")
BASE_KINDS = KINDS[:4]
SPAN = "array<struct<kind:string,start:int,end:int,score:double>>"

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A number that fails at its first digit fails at its others too, so only first digits are tried.
_IP = re.compile(r"(?<![0-9])([0-9]+)\.([0-9]+)\.([0-9]+)\.([0-9]+)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
_NOT_DIGIT = re.compile(r"[^0-9]+")
_WORD = re.compile(r"[a-z]+")

SCORE = {"email": 0.8, "ip": 0.5, "card": 0.8, "phone": 0.6, "iban": 0.9}
NEAR = {
    "email": frozenset("email mail contact write reach correo courriel".split()),
    "ip": frozenset("ip address host server login client dirección adresse".split()),
    "card": frozenset("card credit visa mastercard amex payment pay tarjeta karte carte".split()),
    "phone": frozenset("phone tel telephone call mobile cell fax teléfono telefon téléphone".split()),
    "iban": frozenset("iban account bank transfer cuenta konto compte".split()),
}
AGAINST = frozenset("order invoice version serial isbn ref reference ticket tracking build release".split())


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        d = ord(d) - 48
        if k % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def mod97(code: str) -> bool:
    """The check of an IBAN: the first four characters moved to the end, letters as 10 to 35, remainder 1."""
    turned = code[4:] + code[:4]
    return int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Each match holds one @ that a local part reaches: look at the @ signs, and back from each to where its local part
    or the last match ends."""
    done, at = 0, text.find("@")
    while at >= 0:
        first = at
        while first > done and text[first - 1] in _LOCAL:
            first -= 1
        found = _DOMAIN.match(text, at + 1) if first < at else None
        if found:
            done = found.end()
            yield first, done
        at = text.find("@", max(at + 1, done))


def propose(text: str) -> Iterator[tuple[str, int, int]]:
    """Confirmed spans, kind by kind."""
    if "@" in text:
        for a, b in emails(text):
            yield "email", a, b
    for m in _IP.finditer(text):
        if all(len(g.lstrip("0")) <= 3 and int(g.lstrip("0") or 0) <= 255 for g in m.groups()):
            yield "ip", m.start(), m.end()
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = m[0].replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                yield "card", m.start(), m.end()
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
                yield "phone", m.start(), m.end()
    for m in _IBAN.finditer(text):
        code = m[0].replace(" ", "")
        if 15 <= len(code) <= 34 and mod97(code):
            yield "iban", m.start(), m.end()


def score(kind: str, text: str, start: int, end: int) -> float:
    words = set(_WORD.findall(text[max(0, start - 40) : start].lower() + " " + text[end : end + 20].lower()))
    found = SCORE[kind] + 0.2 * (not words.isdisjoint(NEAR[kind])) - 0.3 * (not words.isdisjoint(AGAINST))
    return round(min(1.0, max(0.0, found)), 2)


def find(text: str) -> list[tuple[str, int, int, float]]:
    return [(k, a, b, score(k, text, a, b)) for k, a, b in propose(text)]


def spans(spark: SparkSession, text: Column) -> Column:
    """All spans of each whole text (kind, start, end, score), by kind in the order of KINDS, then start. Null counts as
    empty; texts without any get an empty list."""
    prepare(spark)

    def run(texts: pd.Series) -> pd.Series:
        names = ("kind", "start", "end", "score")
        return pd.Series([[dict(zip(names, s, strict=True)) for s in find(t)] for t in texts], dtype=object)

    return F.pandas_udf(run, SPAN)(F.coalesce(text.cast("string"), F.lit("")))


def redacted(text: Column, found: Column, least_score: float = 0.0) -> Column:
    """The text with every span of at least that score replaced by its kind in brackets; of overlapping spans the first."""
    wanted = F.filter(found, lambda s: s["score"] >= least_score)
    ordered = F.array_sort(
        F.transform(wanted, lambda s: F.struct(s["start"].alias("a"), s["end"].alias("b"), s["kind"].alias("k")))
    )
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

    def step(state: Column, s: Column) -> Column:
        between = F.substring(text, state["at"] + 1, s["a"] - state["at"])
        added = F.struct(F.concat(state["out"], between, F.lit("["), s["k"], F.lit("]")).alias("out"), s["b"].alias("at"))
        return F.when(s["a"] >= state["at"], added).otherwise(state)

    return F.aggregate(ordered, start, step, lambda s: F.concat(s["out"], F.substring(text, s["at"] + 1, F.length(text))))
