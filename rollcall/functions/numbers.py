"""Ratios, means and rounding that give the same answer however the rows are split over tasks.

Sums stay whole numbers or decimals and are divided once, so no result depends on the order rows arrive in.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HALF_UP, HALF_EVEN = F.round, F.bround


def _exact(c: Column) -> Column:
    """Four decimals, as many as any pay or hours column here may have."""
    return c.cast("decimal(20,4)")


def percent(num: Column, den: Column, places: int | None = None, rounding=HALF_UP) -> Column:
    """``100 * num / den`` as a double, NULL when the denominator is 0. Rounded in decimal, or not at all."""
    if places is None:
        return F.try_divide((_exact(num) * 100).cast("double"), den.cast("double"))
    return rounding(F.try_divide(_exact(num) * 100, _exact(den)), places).cast("double")


def mean(c: Column) -> Column:
    """Exact mean of whole numbers or decimals. The sum keeps the column's own type, where Spark adds fastest."""
    return mean_of(F.sum(c), F.count(c))


def mean_of(total: Column, n: Column) -> Column:
    """Exact mean from a total of at most four decimals and a count."""
    return F.try_divide(total.cast("decimal(30,4)"), n.cast("decimal(20,0)")).cast("decimal(38,10)")


def rounded(c: Column, places: int, rounding=HALF_UP) -> Column:
    return rounding(c, places).cast("double")


def gap_percent(a: Column, b: Column, places: int | None = None, rounding=HALF_UP) -> Column:
    """How far ``b`` lies below ``a``, in percent of ``a``."""
    a, b = a.cast("decimal(18,8)"), b.cast("decimal(18,8)")
    gap = F.try_divide((a - b) * 100, a)
    return gap.cast("double") if places is None else rounding(gap, places).cast("double")


def over_percent(value: Column, base: Column, places: int) -> Column:
    """How far a value lies above its base, in percent of the base."""
    value, base = value.cast("decimal(18,8)"), base.cast("decimal(18,8)")
    return HALF_UP(F.try_divide((value - base) * 100, base), places).cast("double")


def spell_score(spells: Column, days: Column) -> Column:
    """Spells squared times days, whole. Decimal, since one very active key can pass the range of a bigint."""
    spells = spells.cast("decimal(12,0)")
    return (spells * spells * days.cast("decimal(13,0)")).cast("decimal(38,0)")


def text_number(c: Column, places: int) -> Column:
    """A number as text with a fixed number of decimals."""
    return c.cast(f"decimal(30,{places})").cast("string")
