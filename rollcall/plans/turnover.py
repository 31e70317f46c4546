"""Starters, leavers and turnover. Each turnover definition keeps its own name."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.functions.dates import month_of, month_spine
from rollcall.functions.numbers import HALF_EVEN, mean, percent, rounded
from rollcall.operators.rollup import ROWS, by_attribute, distinct_heads, stitch
from rollcall.plans.headcount import active, is_active, value_counts



def monthly_flow(employees: DataFrame, leavers: DataFrame, first: dt.date, last: dt.date) -> DataFrame:
    """Starters, leavers and net change for every month from first to last."""

    def per_month(df, day, name):
        return (
            df.filter((F.col(day) >= F.lit(first)) & (F.col(day) < F.add_months(F.lit(last), 1)))
            .groupBy(month_of(F.col(day)).alias("month_start"))
            .agg(F.count(ROWS).alias(name))
        )

    starters = per_month(employees, "hire_date", "starters")
    gone = per_month(leavers, "leaving_date", "leavers")
    joined = month_spine(employees.sparkSession, first, last).join(starters, "month_start", "left").join(
        gone, "month_start", "left"
    )
    came, went = F.coalesce("starters", F.lit(0)), F.coalesce("leavers", F.lit(0))
    return joined.orderBy("month_start").select(
        F.date_format("month_start", "yyyy-MM").alias("year_month"),
        came.alias("starters"),
        went.alias("leavers"),
        (came - went).alias("net_change"),
    )


def turnover_by_department(employees: DataFrame, leavers: DataFrame, benchmark: float = 8.5) -> DataFrame:
    """K5: distinct leavers over the mean of all distinct heads and leavers."""
    people = distinct_heads(employees, ["department"])
    gone = leavers.select("employee_id").distinct().withColumn("gone", F.lit(True))
    parts = people.join(gone, "employee_id", "left").groupBy("department").agg(
        F.count("employee_id").alias("heads"), F.count("gone").alias("known_leavers")
    )
    return (
        parts
        .select(
            "department",
            F.col("heads").alias("total_headcount"),
            F.col("known_leavers").alias("total_leavers"),
            percent(F.col("known_leavers") * 2, F.col("heads") + F.col("known_leavers"), 1).alias("turnover_rate_pct"),
            F.lit(benchmark).alias("sector_benchmark_pct"),
        )
        .orderBy(F.desc_nulls_first("turnover_rate_pct"), "department")
    )


def active_turnover_by_department(employees: DataFrame, leavers: DataFrame) -> DataFrame:
    """C4: leavers over active heads and leavers; 0 where a department lacks either."""
    gone = by_attribute(leavers, employees, ["department"], {"gone": F.count(ROWS)})
    now = active(employees).groupBy("department").agg(F.count(ROWS).alias("now"))
    rate = percent(F.col("gone"), F.col("now") + F.col("gone"))
    return (
        stitch(["department"], gone, now)
        .filter("department is not null")
        .select("department", F.coalesce(rate, F.lit(0.0)).alias("turnover_pct"))
        .orderBy("turnover_pct", "department")
    )


def turnover_variants(employees: DataFrame, leavers: DataFrame, by: list[str]) -> DataFrame:
    """The five definitions side by side, unrounded, for any grouping of employees."""
    parts = _department_parts(employees, leavers, by)
    heads, now, gone = F.col("heads"), F.col("active_heads"), F.col("known_leavers")
    return parts.select(
        *by,
        percent(gone * 2, heads + gone).alias("leavers_per_mean_of_all"),
        percent(gone, heads).alias("leavers_per_all"),
        percent(gone, now + gone).alias("leavers_per_active_and_leavers"),
        percent(heads - now, heads).alias("inactive_per_all"),
        percent(gone * 2, now + gone).alias("leavers_per_mean_of_active"),
    )


def leavers_by_reason(leavers: DataFrame) -> DataFrame:
    """Leavers, mean tenure and share of exit interviews."""
    n = F.count(ROWS)
    return (
        leavers.dropna(subset=["reason_for_leaving"])
        .groupBy("reason_for_leaving")
        .agg(
            n.alias("count"),
            rounded(mean(F.col("years_of_service")), 1, HALF_EVEN).alias("avg_tenure"),
            percent(F.count_if("exit_interview_completed"), F.count("exit_interview_completed"), 1, HALF_EVEN).alias(
                "exit_interview_pct"
            ),
        )
        .orderBy("reason_for_leaving")
    )


def leavers_by_destination(leavers: DataFrame) -> DataFrame:
    """Leavers per destination and their share."""
    return value_counts(leavers, "destination", "count", "pct_of_leavers")



def _department_parts(employees, leavers, by):
    heads = employees.groupBy(*by).agg(F.count(ROWS).alias("heads"), F.count_if(is_active()).alias("active_heads"))
    gone = by_attribute(
        leavers, employees, by, {"known_leavers": F.count(ROWS)}, how="inner"
    )
    filled = ["heads", "active_heads", "known_leavers"]
    return stitch(by, heads, gone).fillna(0, subset=filled)
