"""Headcount and workforce composition."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rollcall.functions.bands import lookup
from rollcall.functions.dates import completed_years
from rollcall.functions.numbers import HALF_EVEN, mean, percent, rounded
from rollcall.operators.rollup import ROWS
from rollcall.sources.schemas import ACTIVE, FEMALE, MALE, SALARY_BANDS


def is_active():
    return F.col("status") == ACTIVE


def active(employees: DataFrame) -> DataFrame:
    return employees.filter(is_active())


def women():
    return F.count_if(F.col("gender") == FEMALE)


def men():
    return F.count_if(F.col("gender") == MALE)


def headcount_by_contract(employees: DataFrame, by=("department", "employment_type")) -> DataFrame:
    """K1: heads, active heads, share active and mean pay."""
    heads, now = F.count(ROWS), F.count_if(is_active())
    return (
        employees.groupBy(*by)
        .agg(
            heads.alias("headcount"),
            now.alias("active_count"),
            percent(now, heads, 1).alias("pct_active"),
            rounded(mean(F.col("salary")), 0).alias("avg_salary"),
        )
        .orderBy(*[F.asc_nulls_last(c) for c in by])
    )


def gender_by_grade(employees: DataFrame) -> DataFrame:
    """K2: active heads by grade and role type, share of women among all genders, mean pay."""
    heads = F.count(ROWS)
    return (
        active(employees)
        .groupBy("grade", "is_academic")
        .agg(
            heads.alias("total_headcount"),
            women().alias("female_count"),
            men().alias("male_count"),
            percent(women(), heads, 1).alias("pct_female"),
            rounded(mean(F.col("salary")), 0).alias("avg_salary"),
        )
        .orderBy(F.desc_nulls_first("is_academic"), F.desc_nulls_first("avg_salary"), "grade")
    )


def with_salary_band(employees: DataFrame, bands: dict[str, str] = SALARY_BANDS) -> DataFrame:
    """The published pay band of the grade."""
    return employees.withColumn("benchmark_salary_band", lookup(F.col("grade"), bands, "Unknown"))


def active_workforce(employees: DataFrame, as_of: dt.date) -> DataFrame:
    """V1: the active staff with completed years of service."""
    return active(employees).select(
        "employee_id", "first_name", "last_name", "gender", "department", "job_title", "grade", "employment_type",
        "salary", "hire_date", "campus", "is_academic",
        completed_years(F.col("hire_date"), as_of).alias("years_of_service"),
        "benchmark_salary_band",
    )


def department_headcount(employees: DataFrame) -> DataFrame:
    """Active heads per department, smallest first."""
    counted = active(employees).dropna(subset=["department"]).groupBy("department").agg(F.count(ROWS).alias("headcount"))
    return counted.orderBy("headcount", "department")


def contract_shares(employees: DataFrame) -> DataFrame:
    """Active heads per employment type and their share."""
    return value_counts(active(employees), "employment_type", "count", "pct", places=None)


def value_counts(df: DataFrame, column: str, count_name: str, share_name: str, places: int | None = 1) -> DataFrame:
    """Rows per value, most frequent first, with the share of all rows that have a value."""
    counted = df.dropna(subset=[column]).groupBy(column).agg(F.count(ROWS).alias(count_name))
    return with_share(counted, count_name, share_name, places).orderBy(F.desc(count_name), column)


def with_share(counted: DataFrame, count_name: str, share_name: str, places: int | None = 1) -> DataFrame:
    """Each group's share of the sum over all groups, half to even."""
    everything = counted.agg(F.sum(count_name)).scalar()
    return counted.withColumn("everything", everything).select(
        *counted.columns, percent(F.col(count_name), F.col("everything"), places, HALF_EVEN).alias(share_name)
    )


def overview(employees: DataFrame) -> DataFrame:
    """Heads and mean pay by department, grade, gender and employment type, all statuses."""
    keys = ["department", "grade", "gender", "employment_type"]
    pay = HALF_EVEN(mean(F.col("salary")), 0).cast("bigint")
    return (
        employees.dropna(subset=keys)
        .groupBy(*keys)
        .agg(F.count(ROWS).alias("headcount"), pay.alias("mean_salary"))
        .orderBy(*keys)
    )


def grade_pay_ranges(employees: DataFrame, bands: dict[str, str] = SALARY_BANDS) -> DataFrame:
    """Lowest and highest pay of each grade beside its published band."""
    ranges = employees.groupBy("grade").agg(
        F.min("salary").cast("double").alias("min_salary"), F.max("salary").cast("double").alias("max_salary")
    )
    return with_salary_band(ranges, bands).orderBy("grade")


def gender_mix(employees: DataFrame, by=("grade",)) -> DataFrame:
    """Active heads by gender and their share within the group."""
    counted = active(employees).groupBy(*by, "gender").agg(F.count(ROWS).alias("headcount"))
    whole = F.sum("headcount").over(Window.partitionBy(*by))
    return counted.withColumn("pct_of_group", percent(F.col("headcount"), whole, 1)).orderBy(*by, "gender")
