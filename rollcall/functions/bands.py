"""Status bands. The thresholds and labels of each rule."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _worded(case: Column, otherwise: str, value: Column) -> Column:
    return F.when(value.isNotNull(), case.otherwise(otherwise))


def compliance_rag(pct: Column, words=("GREEN", "AMBER", "RED"), good: float = 95, fair: float = 80) -> Column:
    """At least 95 is good and at least 80 fair; no value counts as poor."""
    green, amber, red = words
    return F.when(pct >= good, green).when(pct >= fair, amber).otherwise(red)


def absence_rag(pct: Column, good: float = 3, fair: float = 4.5) -> Column:
    """The measure: below 3 is green and below 4.5 amber."""
    return F.when(pct < good, "Green").when(pct < fair, "Amber").otherwise("Red")


def absence_rag_rule(pct: Column) -> Column:
    """The formatting rule, where 4.5 itself is still amber."""
    return _worded(F.when(pct < 3, "Green").when(pct <= 4.5, "Amber"), "Red", pct)


def pay_gap_rag(pct: Column) -> Column:
    return _worded(F.when(pct < 10, "Green").when(pct <= 16, "Amber"), "Red", pct)


def spell_rag(score: Column) -> Column:
    return _worded(F.when(score < 100, "Green").when(score < 450, "Amber"), "Red", score)


def spell_risk(score: Column) -> Column:
    return F.when(score < 100, "Low").when(score < 450, "Medium").otherwise("High — Review Recommended")


def spell_band(score: Column) -> Column:
    return F.when(score < 100, "Low (0–99)").when(score < 450, "Medium (100–449)").otherwise("High (450+)")


def variance_class(variance: Column) -> Column:
    """The colour a benchmark variance is listed in."""
    return F.when(variance < -20, "red").when(F.abs(variance) < 10, "green").otherwise("grey")


def pay_direction(men: Column, women: Column) -> Column:
    return F.when(men > women, "Men paid more").when(women > men, "Women paid more").otherwise("Equal")


def lookup(c: Column, table: dict[str, object], default: object = None) -> Column:
    """Replace a value through a short fixed table."""
    if not table:
        return F.lit(default)
    words = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
    return F.coalesce(words[c], F.lit(default)) if default is not None else words[c]
