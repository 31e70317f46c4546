"""Training completion, mandatory compliance and spend. Each compliance definition keeps its own name."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.functions.bands import compliance_rag
from rollcall.functions.dates import months_before
from rollcall.functions.numbers import HALF_EVEN, mean_of, percent, rounded
from rollcall.functions.text import full_name
from rollcall.operators.rollup import ROWS, attach, by_attribute, distinct_heads, per_employee, stitch, with_totals
from rollcall.plans.headcount import active, is_active, value_counts

# Fixed values.
COMPLIANCE_TARGET = 95.0
SPEND_BENCHMARK = 1200
MONTHS = 12
NO_TRAINING_FLAG = "COMPLIANCE FLAG — No mandatory training in 12 months"


def completion_by_category(employees: DataFrame, training: DataFrame) -> DataFrame:
    """Enrolments, passes and cost by department and category."""
    grouped = by_attribute(training, employees, ["department"], _completion_sums(), keys=["category"])
    return grouped.select(
        "department",
        "category",
        F.col("records").alias("total_enrollments"),
        "passed",
        percent(F.col("passed"), F.col("records"), 1).alias("completion_rate_pct"),
        rounded(F.col("cost"), 2).alias("total_cost_eur"),
        rounded(mean_of(F.col("cost"), F.col("costed")), 2).alias("avg_cost_per_enrollment"),
    ).orderBy("department", "category")


def _completion_sums():
    return {
        "records": F.count(ROWS),
        "passed": F.count_if("passed"),
        "cost": F.sum("cost_eur"),
        "costed": F.count("cost_eur"),
    }


def recent_passes(training: DataFrame, as_of: dt.date, months: int = MONTHS) -> DataFrame:
    """Mandatory courses passed within the months up to a day, the boundary day included."""
    recent = F.col("completion_date") >= months_before(as_of, months)
    return training.filter(F.col("mandatory") & F.col("passed") & recent)


def mandatory_courses(training: DataFrame) -> DataFrame:
    """The distinct mandatory courses."""
    return training.filter("mandatory").select("course_name").distinct()


def _recent_pass(as_of: dt.date) -> Column:
    return F.col("passed") & (F.col("completion_date") >= months_before(as_of, MONTHS))


def _courses(training: DataFrame, counts: dict[str, Column]) -> tuple[DataFrame, Column]:
    """One row per employee and mandatory course with some counts, and the number of courses as a scalar.

    Both come from the same rows, so that training is read and shuffled once: the scalar asks for every count too (none is
    negative), or Spark would prune them there, see two different plans and run both.
    """
    courses = training.filter("mandatory").groupBy("employee_id", "course_name")
    courses = courses.agg(*[value.alias(name) for name, value in counts.items()])
    seen = sum((F.col(name) for name in counts), F.lit(0)) >= 0
    needed = courses.filter(seen).select("course_name").distinct().agg(F.count("course_name").alias("needed"))
    return courses, needed.scalar()


def _with_courses(employees: DataFrame, totals: DataFrame) -> DataFrame:
    """Employees with their totals of courses. Joined on a key that is never NULL: otherwise Spark would drop records without
    an employee before it adds up here, but not where it counts courses, and read training for each."""
    keyed = totals.select(F.coalesce("employee_id", F.lit("\0")).alias("key"), *totals.columns[1:])
    return employees.join(keyed, F.col("employee_id") == F.col("key"), "left").drop("key")


def full_compliance(employees: DataFrame, training: DataFrame, as_of: dt.date) -> DataFrame:
    """Share of active staff who passed every mandatory course in the last 12 months, with status."""
    courses, needed = _courses(training, {"recent": F.count(F.when(_recent_pass(as_of), 1))})
    totals = courses.groupBy("employee_id").agg(
        F.count(F.when(F.col("recent") > 0, F.col("course_name"))).alias("recent_courses")
    )
    people = _with_courses(active(employees).select("employee_id", "department"), totals)
    compliant = F.count_if(F.coalesce("recent_courses", F.lit(0)) >= F.col("needed"))
    grouped = (
        people.withColumn("needed", needed)
        .groupBy("department")
        .agg(F.count(ROWS).alias("active_staff"), compliant.alias("fully_compliant"))
    )
    rate = F.col("compliance_rate_pct")
    return (
        grouped.withColumn("compliance_rate_pct", percent(F.col("fully_compliant"), F.col("active_staff"), 1))
        .select("*", F.lit(COMPLIANCE_TARGET).alias("target_pct"), compliance_rag(rate).alias("rag_status"))
        .orderBy(F.asc_nulls_last("compliance_rate_pct"), "department")
    )


def spend_per_head(employees: DataFrame, training: DataFrame) -> DataFrame:
    """Training spend of active staff per distinct head; a department without records has no spend, not 0. As a join
    in SQL gives it, an employee held twice counts their spend twice."""
    people = with_totals(distinct_heads(active(employees), ["department"]), training, {"cost": F.sum("cost_eur")})
    grouped = people.groupBy("department").agg(
        F.count("employee_id").alias("heads"), F.sum(F.col("cost") * F.col("copies")).alias("cost")
    )
    return grouped.select(
        "department",
        F.col("heads").alias("active_headcount"),
        rounded(F.col("cost"), 0).alias("total_training_spend_eur"),
        rounded(mean_of(F.col("cost"), F.col("heads")), 0).alias("spend_per_employee_eur"),
        F.lit(SPEND_BENCHMARK).alias("sector_benchmark_eur_per_head"),
    ).orderBy(F.desc_nulls_first("spend_per_employee_eur"), "department")


def without_mandatory_training(employees: DataFrame, training: DataFrame, as_of: dt.date) -> DataFrame:
    """Active staff with no mandatory pass in the last 12 months."""
    passed = recent_passes(training, as_of).select("employee_id").distinct()
    return (
        active(employees)
        .join(passed, "employee_id", "left_anti")
        .select(
            "employee_id",
            full_name(F.col("first_name"), F.col("last_name")).alias("full_name"),
            "department",
            "job_title",
            "hire_date",
            F.lit(0).cast("bigint").alias("mandatory_completions_12m"),
            F.lit(NO_TRAINING_FLAG).alias("flag"),
        )
        .orderBy("department", "hire_date", "employee_id")
    )


def top_without_mandatory_training(employees: DataFrame, training: DataFrame, as_of: dt.date, k: int = 10) -> DataFrame:
    """The first few of them, longest-serving first."""
    people = without_mandatory_training(employees, training, as_of)
    return people.orderBy("hire_date", "employee_id").limit(k).select("employee_id", "full_name", "department", "hire_date")


def completion_by_department(employees: DataFrame, training: DataFrame) -> DataFrame:
    """Passes over records by department, banded at 90 and 80."""
    grouped = by_attribute(
        training, employees, ["department"], {"passed": F.count_if("passed"), "total": F.count("passed")}
    )
    pct = F.col("completion_pct")
    return (
        grouped.dropna(subset=["department"])
        .withColumn("completion_pct", percent(F.col("passed"), F.col("total")))
        .withColumn("band", F.when(pct >= 90, "green").when(pct >= 80, "amber").otherwise("red"))
        .orderBy("completion_pct", "department")
    )


def every_record_passed(training: DataFrame) -> DataFrame:
    """Per employee with mandatory records: whether all of them were passed."""
    return per_employee(training.filter("mandatory"), {"compliant": F.bool_and("passed")})


def record_compliance_by_department(employees: DataFrame, training: DataFrame) -> DataFrame:
    """C11: employees whose mandatory records were all passed; without records not compliant; all statuses."""
    people = employees.select("employee_id", "department").join(every_record_passed(training), "employee_id", "left")
    pct = F.col("compliance_pct")
    return (
        people.dropna(subset=["department"])
        .groupBy("department")
        .agg(F.count_if("compliant").alias("compliant"), F.count(ROWS).alias("total"))
        .withColumn("compliance_pct", percent(F.col("compliant"), F.col("total")))
        .withColumn("band", F.when(pct < 80, "red").when(pct < 95, "amber").otherwise("green"))
        .orderBy("compliance_pct", "department")
    )


def training_sheet(employees: DataFrame, training: DataFrame) -> DataFrame:
    """Records, passes, cost and completion by department and category."""
    grouped = by_attribute(training, employees, ["department"], _completion_sums(), keys=["category"], how="left")
    return (
        grouped.dropna(subset=["department", "category"])
        .select(
            "department",
            "category",
            F.col("records").alias("completions"),
            "passed",
            HALF_EVEN(F.col("cost"), 0).cast("bigint").alias("total_cost"),
            percent(F.col("passed"), F.col("records"), 1, HALF_EVEN).alias("completion_rate_pct"),
        )
        .orderBy("department", "category")
    )


def provider_split(training: DataFrame) -> DataFrame:
    """Records per provider and their share."""
    return value_counts(training, "provider", "records", "pct")


def completions_by_category(training: DataFrame) -> DataFrame:
    """Passed records per category."""
    return value_counts(training.filter("passed"), "category", "completions", "pct")


def department_status(employees: DataFrame, training: DataFrame) -> DataFrame:
    """Completion, mandatory compliance (any pass over active heads) and status by department."""
    records = by_attribute(
        training, employees, ["department"], {"passed": F.count_if("passed"), "records": F.count(ROWS)}
    )
    passed_any = _employees_with(training.filter(F.col("mandatory") & F.col("passed")))
    covered = attach(passed_any, employees, ["department"]).groupBy("department").agg(F.count(ROWS).alias("covered"))
    heads = active(employees).groupBy("department").agg(F.count(ROWS).alias("heads"))
    pct = F.col("mandatory_compliance_pct")
    return (
        stitch(["department"], records, covered, heads)
        .select(
            "department",
            percent(F.col("passed"), F.col("records"), 1).alias("completion_pct"),
            percent(F.coalesce("covered", F.lit(0)), F.col("heads"), 1).alias("mandatory_compliance_pct"),
        )
        .withColumn("rag", compliance_rag(pct, ("Green", "Amber", "Red")))
        .orderBy("department")
    )


def _employees_with(training):
    return training.select("employee_id").distinct()


def compliance_variants(employees: DataFrame, training: DataFrame, as_of: dt.date, by: list[str]) -> DataFrame:
    """The five definitions of mandatory compliance side by side, for any grouping of employees, unrounded.

    Every course in 12 months (active staff) · any pass in 12 months over active heads · every record passed, of
    all employees · every record passed, of those with records · any pass ever over active heads.
    """
    counts = {
        "recent": F.count(F.when(_recent_pass(as_of), 1)),
        "passes": F.count(F.when(F.col("passed"), 1)),
        "known": F.count("passed"),
    }
    courses, needed = _courses(training, counts)
    passes, known = F.sum("passes"), F.sum("known")
    totals = courses.groupBy("employee_id").agg(
        F.count(F.when(F.col("recent") > 0, F.col("course_name"))).alias("recent_courses"),
        (passes > 0).alias("any_pass"),
        F.when(known > 0, passes == known).alias("all_passed"),
    )
    people = _with_courses(employees.select("employee_id", "status", *by), totals)
    recent_courses = F.coalesce("recent_courses", F.lit(0))

    def count_of(cond: Column) -> Column:
        return F.count_if(F.coalesce(cond, F.lit(False)))

    parts = (
        people.withColumn("needed", needed)
        .groupBy(*by)
        .agg(
            F.count_if(is_active()).alias("now"),
            F.count(ROWS).alias("heads"),
            F.count("all_passed").alias("with_records"),
            count_of(is_active() & (recent_courses >= F.col("needed"))).alias("every_recent"),
            count_of(recent_courses > 0).alias("any_recent"),
            count_of(F.col("all_passed")).alias("all_records"),
            count_of(F.col("any_pass")).alias("any_ever"),
        )
    )
    return parts.select(
        *by,
        percent(F.col("every_recent"), F.col("now")).alias("every_course_12m_pct"),
        percent(F.col("any_recent"), F.col("now")).alias("any_pass_12m_pct"),
        percent(F.col("all_records"), F.col("heads")).alias("all_records_of_all_pct"),
        percent(F.col("all_records"), F.col("with_records")).alias("all_records_of_recorded_pct"),
        percent(F.col("any_ever"), F.col("now")).alias("any_pass_ever_pct"),
    )
