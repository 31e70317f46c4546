"""Absence rates, spells and return-to-work interviews. Rates keep the published basis of 230 working days."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rollcall.functions.bands import spell_band, spell_rag, spell_risk
from rollcall.functions.dates import MONTH_NAMES, month_of, month_spine
from rollcall.functions.numbers import HALF_EVEN, mean, mean_of, percent, rounded, spell_score
from rollcall.functions.text import full_name
from rollcall.operators.quantiles import distribution, histogram, leading_digits
from rollcall.operators.rollup import ROWS, attach, by_attribute, distinct_heads, per_employee, stitch, with_totals
from rollcall.plans.headcount import active, is_active, with_share
from rollcall.sources.schemas import SICK_TYPES

# Fixed values.
WORKING_DAYS = 230
RATE_BENCHMARK, INTERVIEW_TARGET = 4.5, 95.0
INTERVIEW_DAYS = 3


def is_sick() -> Column:
    return F.col("absence_type").isin(*SICK_TYPES)


def sick(absences: DataFrame) -> DataFrame:
    return absences.filter(is_sick())


def _rate(days, heads, working_days, places=2):
    return percent(days, heads * working_days, places)


def sick_rate_by_department(employees: DataFrame, absences: DataFrame, working_days: int = WORKING_DAYS) -> DataFrame:
    """K9: sick days of the active staff over their working days."""
    grouped = _active_days(employees, sick(absences))
    return grouped.select(
        "department",
        F.col("heads").alias("active_headcount"),
        F.col("days").alias("total_days_absent"),
        _rate(F.col("days"), F.col("heads"), working_days).alias("absence_rate_pct"),
        F.lit(RATE_BENCHMARK).alias("public_sector_benchmark_pct"),
    ).orderBy(F.desc_nulls_first("absence_rate_pct"), "department")


def absence_rate_by_department(employees: DataFrame, absences: DataFrame, working_days: int = WORKING_DAYS) -> DataFrame:
    """V2: as the sick rate, for every type of absence."""
    grouped = _active_days(employees, absences)
    return grouped.select(
        "department",
        F.col("heads").alias("headcount"),
        F.col("days").alias("total_days_absent"),
        _rate(F.col("days"), F.col("heads"), working_days).alias("absence_rate_pct"),
    )


def _active_days(employees, absences):
    """Distinct active heads and days by department. Days are those of the joined rows, as a join in SQL gives them: an
    employee held twice counts their days twice."""
    people = distinct_heads(active(employees), ["department"])
    days = with_totals(people, absences, {"days": F.sum("days_absent")})
    return days.groupBy("department").agg(
        F.count("employee_id").alias("heads"), F.coalesce(F.sum(F.col("days") * F.col("copies")), F.lit(0)).alias("days")
    )


def sick_leave_breakdown(employees: DataFrame, absences: DataFrame) -> DataFrame:
    """Sick leave by year, department and type."""
    yearly = sick(absences).withColumn("year", F.year("start_date"))
    grouped = by_attribute(
        yearly,
        employees,
        ["department"],
        {
            "instances": F.count(ROWS),
            "total_days": F.sum("days_absent"),
            "with_days": F.count("days_absent"),
            "rtw_interviews_held": F.count_if("return_to_work_interview"),
        },
        keys=["year", "absence_type"],
    )
    return grouped.select(
        "year",
        "department",
        "absence_type",
        "instances",
        "total_days",
        rounded(mean_of(F.col("total_days"), F.col("with_days")), 1).alias("avg_days_per_instance"),
        "rtw_interviews_held",
    ).orderBy("year", "department", "absence_type")


def spell_scores(absences: DataFrame) -> DataFrame:
    """Spells, days and score (spells squared times days) per employee of the given absences; every row is a spell."""
    totals = per_employee(absences, {"spells": F.count("absence_id"), "total_days": F.sum("days_absent")})
    return totals.withColumn("score", spell_score(F.col("spells"), F.col("total_days")))


def distinct_spells(absences: DataFrame) -> DataFrame:
    """Distinct absences and the days of all rows per employee, in two steps that both combine on the map side."""
    each = absences.groupBy("employee_id", "absence_id").agg(F.sum("days_absent").alias("days"))
    return per_employee(each, {"spells": F.count("absence_id"), "days": F.sum("days")})


def top_spell_scores(employees: DataFrame, absences: DataFrame, k: int = 50) -> DataFrame:
    """The active employees with the highest sick-leave score. A spell is a distinct absence."""
    named = active(employees).select(
        "employee_id", full_name(F.col("first_name"), F.col("last_name")).alias("full_name"), "department"
    )
    people = distinct_heads(named, ["full_name", "department"])
    joined = distinct_spells(sick(absences)).join(people, "employee_id")
    scored = joined.withColumn("total_days", F.col("days") * F.col("copies")).withColumn(
        "score", spell_score(F.col("spells"), F.col("total_days"))
    )
    return (
        scored.orderBy(F.desc_nulls_first("score"), "employee_id", "full_name", "department")
        .limit(k)
        .select(
            "employee_id",
            "full_name",
            "department",
            "spells",
            F.col("total_days").alias("total_days_absent"),
            F.col("score").cast("double").alias("bradford_factor"),
            spell_risk(F.col("score")).alias("risk_band"),
        )
    )


def top_spell_colours(employees: DataFrame, absences: DataFrame, k: int = 10) -> DataFrame:
    """The highest scores with a display rank and a status colour."""
    top = top_spell_scores(employees, absences, k)
    order = Window.partitionBy(F.lit(0)).orderBy(F.desc("bradford_factor"), "employee_id")
    return top.select(
        F.row_number().over(order).alias("display_rank"),
        "employee_id",
        "full_name",
        "bradford_factor",
        spell_rag(F.col("bradford_factor")).alias("rag"),
    )


def interview_compliance(employees: DataFrame, absences: DataFrame) -> DataFrame:
    """Return-to-work interviews held after sick leave of three days or more."""
    held = F.col("return_to_work_interview")
    grouped = by_attribute(
        sick(absences).filter(F.col("days_absent") >= INTERVIEW_DAYS),
        employees,
        ["department"],
        {"eligible_absences": F.count(ROWS), "rtw_completed": F.count_if(held), "rtw_missing": F.count_if(~held)},
    )
    return grouped.select(
        "*",
        percent(F.col("rtw_completed"), F.col("eligible_absences"), 1).alias("compliance_rate_pct"),
        F.lit(INTERVIEW_TARGET).alias("target_pct"),
    ).orderBy(F.asc_nulls_last("compliance_rate_pct"), "department")


def rate_heat_map(employees: DataFrame, absences: DataFrame, working_days: int = WORKING_DAYS) -> DataFrame:
    """Absence rate by department and month of the year, every type; all twelve months always present."""
    monthly = by_attribute(
        absences.withColumn("month", F.month("start_date")),
        employees,
        ["department"],
        {"days": F.sum("days_absent")},
        keys=["month"],
    )
    wide = monthly.groupBy("department").pivot("month", list(range(1, 13))).agg(F.sum("days"))
    heads = active(employees).groupBy("department").agg(F.count(ROWS).alias("heads"))
    rates = [
        F.coalesce(percent(F.col(str(i)), F.col("heads") * working_days), F.lit(0.0)).alias(name)
        for i, name in enumerate(MONTH_NAMES, 1)
    ]
    return wide.join(heads, "department").select("department", *rates).orderBy("department")


def score_histogram(absences: DataFrame, bins: int = 40) -> DataFrame:
    """Spread of the sick-leave scores of everyone, with their median."""
    scores = spell_scores(sick(absences)).select("score")
    spread = distribution(scores, [], "score", bucket=leading_digits, with_total=False)
    median = spread.select(F.col("median").cast("double"))
    return (
        histogram(scores, "score", bins)
        .withColumn("median", median.scalar())
        .withColumnRenamed("count", "employees")
        .orderBy("bin")
    )


def types_summary(absences: DataFrame) -> DataFrame:
    """Instances, days, mean days and share of all instances by type."""
    grouped = (
        absences.dropna(subset=["absence_type"])
        .groupBy("absence_type")
        .agg(
            F.count("absence_id").alias("count"),
            F.sum("days_absent").alias("total_days"),
            rounded(mean(F.col("days_absent")), 1, HALF_EVEN).alias("avg_days"),
        )
    )
    return with_share(grouped, "count", "pct_of_total").orderBy("absence_type")


def score_bands(absences: DataFrame) -> DataFrame:
    """Employees per score band, everyone with sick leave; empty bands included, the top band open."""
    score = F.col("score")
    one = spell_scores(sick(absences)).agg(
        F.count_if(score < 100).alias("low"),
        F.count_if((score >= 100) & (score < 450)).alias("medium"),
        F.count_if(score >= 450).alias("high"),
        F.count(ROWS).alias("n"),
    )
    bands = F.array(
        *[
            F.struct(spell_band(F.lit(edge)).alias("band"), F.col(name).alias("employees"), F.col("n"))
            for edge, name in ((0, "low"), (100, "medium"), (450, "high"))
        ]
    )
    return one.select(F.inline(bands)).select(
        "band", "employees", percent(F.col("employees"), F.col("n"), 1, HALF_EVEN).alias("pct")
    )


def sick_trend(absences: DataFrame, first: dt.date, last: dt.date) -> DataFrame:
    """G1: certified and uncertified sick leave started in each month."""
    spine = month_spine(absences.sparkSession, first, last).withColumn(
        "absence_type", F.explode(F.array(*[F.lit(t) for t in SICK_TYPES]))
    )
    counted = (
        sick(absences)
        .filter((F.col("start_date") >= F.lit(first)) & (F.col("start_date") < F.add_months(F.lit(last), 1)))
        .groupBy(month_of(F.col("start_date")).alias("month_start"), "absence_type")
        .agg(F.count(ROWS).alias("instances"), F.sum("days_absent").alias("days"))
    )
    return (
        spine.join(counted, ["month_start", "absence_type"], "left")
        .orderBy("month_start", "absence_type")
        .select(
            F.date_format("month_start", "yyyy-MM").alias("year_month"),
            "absence_type",
            F.coalesce("instances", F.lit(0)).alias("instances"),
            F.coalesce("days", F.lit(0)).alias("total_days"),
        )
    )


def types_by_department(employees: DataFrame, absences: DataFrame) -> DataFrame:
    """Instances and days by department and type."""
    sums = {"instances": F.count(ROWS), "total_days": F.sum("days_absent")}
    grouped = by_attribute(absences, employees, ["department"], sums, keys=["absence_type"])
    return grouped.select("department", "absence_type", "instances", "total_days").orderBy("department", "absence_type")


def absence_rate_variants(
    employees: DataFrame, absences: DataFrame, by: list[str], working_days: int = WORKING_DAYS
) -> DataFrame:
    """The three definitions side by side, for any grouping of employees.

    Sick days of active staff, all days of active staff, and sick days of everyone, each over the active staff.
    """
    sums = {"days": F.sum("days_absent"), "sick_days": F.sum(F.when(is_sick(), F.col("days_absent")))}
    people = attach(per_employee(absences, sums), employees, [*by, "status"])
    days = people.groupBy(*by).agg(
        F.sum(F.when(is_active(), F.col("sick_days"))).alias("active_sick"),
        F.sum(F.when(is_active(), F.col("days"))).alias("active_all"),
        F.sum("sick_days").alias("everyone_sick"),
    )
    heads = active(employees).groupBy(*by).agg(F.count(ROWS).alias("heads"))
    parts = stitch(by, days, heads).fillna(0, subset=["active_sick", "active_all", "everyone_sick", "heads"])
    return parts.select(
        *by,
        _rate(F.col("active_sick"), F.col("heads"), working_days).alias("sick_of_active_pct"),
        _rate(F.col("active_all"), F.col("heads"), working_days).alias("all_of_active_pct"),
        _rate(F.col("everyone_sick"), F.col("heads"), working_days).alias("sick_of_everyone_pct"),
    )
