"""Rules over the rows of one table, and references between tables.

Rows are flagged and kept. All rules of a table are counted in one pass; references are checked on distinct keys
first, so neither a very common key nor a missing one is ever gathered in one task.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.functions.numbers import HALF_EVEN
from rollcall.operators.rollup import ROWS


@dataclass(frozen=True)
class Rule:
    """What must not be: a condition on a row, the flag it leaves, and the rows it applies to (all by default).

    A rule that a reference must exist names its key and whether a missing one breaks it; its condition is the marker
    ``mark_orphans`` leaves.
    """

    name: str
    broken: Column
    flag: str | None = None
    applies: Column | None = None
    key: str | None = None
    null_breaks: bool = False


def not_in(column: str, domain: Iterable[str]) -> Column:
    """Outside the allowed values; NULL passes, as a CHECK lets it."""
    return ~F.coalesce(F.col(column).isin(*domain), F.lit(True))


def unless(condition: Column) -> Column:
    """The condition is false; unknown passes, as a CHECK lets it."""
    return ~F.coalesce(condition, F.lit(True))


def flags(rules: list[Rule]) -> Column:
    """The flags of the broken rules, each ended by a semicolon."""
    tokens = [F.when(r.broken, r.flag + ";").otherwise("") for r in rules if r.flag]
    return F.concat(*tokens) if tokens else F.lit("")


def report(df: DataFrame, table: str, rules: list[Rule], resolution: str, known: DataFrame | None = None) -> DataFrame:
    """One row per rule: rows checked, issues, share clean. One pass over the table.

    With a rule on a reference, rows and issues are first counted per key, and the counts, not the rows, meet the one
    column of ``known`` keys.
    """
    key = next((rule.key for rule in rules if rule.key), None)
    counts = []
    for i, rule in enumerate(rules):
        counts.append(F.count(ROWS if rule.applies is None else F.when(rule.applies, 1)).alias(f"total_{i}"))
        if rule.key is None:
            counts.append(F.count_if(rule.broken).alias(f"issues_{i}"))
    one = df.agg(*counts) if key is None else _add_up(df.groupBy(key).agg(*counts), key, rules, known)
    lines = [
        F.struct(
            F.lit(table).alias("table"),
            F.lit(rule.name).alias("check"),
            F.col(f"total_{i}").alias("total_rows"),
            F.col(f"issues_{i}").alias("issues_found"),
        )
        for i, rule in enumerate(rules)
    ]
    base = F.greatest("total_rows", F.lit(1)).cast("decimal(20,0)")
    clean = HALF_EVEN((base - F.col("issues_found")) * 100 / base, 2).cast("double")
    return one.select(F.inline(F.array(*lines))).select(
        "*", clean.alias("pct_clean"), F.lit(resolution).alias("resolution")
    )


def _add_up(per_key, key, rules, known):
    found = known.toDF(key).distinct().withColumn("is_known", F.lit(True))
    sums = []
    for i, rule in enumerate(rules):
        unknown = F.col("is_known").isNull() & (F.lit(rule.null_breaks) | F.col(key).isNotNull())
        issues = F.col(f"issues_{i}") if rule.key is None else F.when(unknown, F.col(f"total_{i}"))
        for name, value in ((f"total_{i}", F.col(f"total_{i}")), (f"issues_{i}", issues)):
            sums.append(F.coalesce(F.sum(value), F.lit(0)).alias(name))
    return per_key.join(found, key, "left").agg(*sums)


def violations(df: DataFrame, table: str, rules: list[Rule]) -> DataFrame:
    """One row per rule: table, rule, rows breaking it. One pass over the table."""
    counts = [F.count_if(rule.broken).alias(f"c{i}") for i, rule in enumerate(rules)]
    lines = [
        F.struct(F.lit(table).alias("table"), F.lit(rule.name).alias("rule"), F.col(f"c{i}").alias("violations"))
        for i, rule in enumerate(rules)
    ]
    return df.agg(*counts).select(F.inline(F.array(*lines)))


def union(frames: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once or are NULL, with their number of rows."""
    return df.groupBy(key).agg(F.count(ROWS).alias("rows")).filter((F.col("rows") > 1) | F.col(key).isNull())


def orphan_keys(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """The distinct non-NULL keys of a child that its parent does not have."""
    known = parent.select(F.col(parent_key).alias(key))
    return child.select(key).filter(F.col(key).isNotNull()).distinct().join(known, key, "left_anti")


def mark_orphans(
    child: DataFrame, key: str, parent: DataFrame, parent_key: str, name: str, spread_by: str, null_breaks: bool = False
) -> DataFrame:
    """Every child row with whether its key is unknown to the parent; a NULL key counts as ``null_breaks`` says.

    One lazy plan: a left join to the distinct known keys, on the key and a number that for rows without a key is a hash of
    ``spread_by``, a column that differs from row to row; so these spread over all tasks. For all others it is 0, which
    takes no room in the exchange; it is written as a remainder by 1, since a join column that is seen to be constant would
    be dropped. A very common key is left to adaptive execution, which may split its rows over tasks: the second join column
    gives both sides an exchange of their own, and nothing after the join asks for their partitioning.
    """
    salt = F.when(F.col(key).isNull(), F.xxhash64(spread_by)).otherwise(F.xxhash64(key) % 1)
    known = parent.select(F.col(parent_key).alias("known_key")).filter("known_key is not null").distinct()
    known = known.withColumn("known_salt", F.xxhash64("known_key") % 1)
    match = (F.col(key) == F.col("known_key")) & (F.col("salt") == F.col("known_salt"))
    unknown = F.col("known_key").isNull() & (F.lit(null_breaks) | F.col(key).isNotNull())
    return (
        child.withColumn("salt", salt).join(known, match, "left")
        .withColumn(name, unknown).drop("salt", "known_key", "known_salt")
    )
