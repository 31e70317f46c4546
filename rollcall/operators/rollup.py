"""Grouping facts by attributes of the employee they belong to."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROWS = "*"


def per_employee(fact: DataFrame, sums: dict[str, Column], keys: Iterable[str] = (), id_col: str = "employee_id"):
    """Add up a fact per employee (and further keys) before it is shuffled, so a very active employee weighs one row."""
    return fact.groupBy(id_col, *keys).agg(*[value.alias(name) for name, value in sums.items()])


def by_attribute(
    fact: DataFrame,
    employees: DataFrame,
    attributes: list[str],
    sums: dict[str, Column],
    keys: Iterable[str] = (),
    how: str = "inner",
    id_col: str = "employee_id",
    narrow: bool = False,
) -> DataFrame:
    """Totals of a fact by employee attributes and by its own keys.

    ``sums`` must be counts or sums. The fact is first added up per employee, joined one-to-one to the employees,
    and added up again; ``how='left'`` keeps facts of unknown employees under NULL attributes. Without attributes
    no join is needed, unless ``narrow`` says that only the facts of these employees count.
    """
    keys = list(keys)
    if not attributes and not narrow:
        return fact.groupBy(*keys).agg(*[value.alias(name) for name, value in sums.items()])
    small = per_employee(fact, sums, keys, id_col)
    joined = attach(small, employees, attributes, "inner" if narrow else how, id_col)
    return joined.groupBy(*attributes, *keys).agg(*[F.sum(name).alias(name) for name in sums])


def with_totals(employees: DataFrame, fact: DataFrame, sums: dict[str, Column]) -> DataFrame:
    """Every employee with the totals of a fact, NULL when there is none."""
    return employees.join(per_employee(fact, sums), "employee_id", "left")


def distinct_heads(employees: DataFrame, attributes: list[str]) -> DataFrame:
    """One row per employee and attributes, with the number of rows that hold them."""
    return employees.groupBy("employee_id", *attributes).agg(F.count(ROWS).alias("copies"))


def attach(
    small: DataFrame, employees: DataFrame, attributes: list[str], how: str = "inner", id_col: str = "employee_id"
) -> DataFrame:
    """Employee attributes for a frame that already has one row per employee (and few keys)."""
    people = _attributes(employees, attributes, id_col)
    return small.join(people if attributes else people.distinct(), id_col, how)


def join_groups(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on group keys where NULL is a group of its own."""
    renamed = right.withColumnsRenamed({k: f"{k} of right" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"{k} of right")) for k in keys]
    return left.join(renamed, reduce(lambda a, b: a & b, same), how).drop(*[f"{k} of right" for k in keys])


def stitch(keys: list[str], *frames: DataFrame) -> DataFrame:
    """Put frames with one row per group side by side: a full outer join on the keys, NULL keys included.

    The frames are small grouped results with different measures, so one union and one grouping does it. Two frames with
    a measure of the same name would be merged unseen, so they are refused.
    """
    named = [c for f in frames for c in f.columns if c not in keys]
    if repeated := sorted({c for c in named if named.count(c) > 1}):
        raise ValueError(f"measures in more than one frame: {', '.join(repeated)}")
    together = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    measures = [c for c in together.columns if c not in keys]
    return together.groupBy(*keys).agg(*[F.max(c).alias(c) for c in measures])


def _attributes(employees, attributes, id_col):
    columns = [c for c in attributes if c != "employee_id"]
    return employees.select(F.col("employee_id").alias(id_col), *columns)
