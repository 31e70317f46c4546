"""Text standardisation."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# A mark that no text holds: initcap starts a word after each space, so every non-letter gets one for a moment.
_BREAK = "\u0001 "


def title_case(c: Column) -> Column:
    """Trim, then upper-case every letter that follows a non-letter and lower-case the rest."""
    spaced = F.regexp_replace(F.trim(c), r"(\P{L})", "$1" + _BREAK)
    return F.replace(F.initcap(spaced), F.lit(_BREAK), F.lit(""))


def match_domain(c: Column, domain: Iterable[str]) -> Column:
    """Trim, and replace a value by the allowed spelling it equals regardless of case."""
    trimmed = F.trim(c)
    allowed = list(domain)
    if not allowed:
        return trimmed
    spelled = F.create_map(*[F.lit(x) for word in allowed for x in (word.lower(), word)])
    return F.coalesce(spelled[F.lower(trimmed)], trimmed)


def full_name(first: Column, last: Column) -> Column:
    return F.concat(first, F.lit(" "), last)
