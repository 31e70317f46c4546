"""Cleaning of the five HR tables: flag and keep, repair references, and one report over all checks."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.functions.dates import years_between
from rollcall.functions.text import match_domain, title_case
from rollcall.operators.quality import Rule, flags, mark_orphans, report, union
from rollcall.operators.rollup import ROWS
from rollcall.plans.headcount import with_salary_band
from rollcall.sources import schemas

# Fixed values.
SALARY_RANGE, AGE_RANGE = (25000, 135000), (18, 70)
SECTOR_ABSENCE_RATE = 4.5
RESOLUTION = "Flagged with dq_flag; FK issues set to NULL"
STANDARD_COLUMNS = {
    "gender": schemas.GENDERS,
    "employment_type": schemas.EMPLOYMENT_TYPES,
    "status": schemas.STATUSES,
    "department": schemas.DEPARTMENTS,
    "campus": schemas.CAMPUSES,
}


def _outside(c: Column, bounds) -> Column:
    return (c < bounds[0]) | (c > bounds[1])


class Cleaning:
    """The checks and repairs of one bundle of tables. A NULL employee of an absence, leaver or training record is an
    unknown one; a NULL manager or hire is none.
    """

    def __init__(
        self,
        tables,
        domains: dict[str, tuple] = STANDARD_COLUMNS,
        bands: dict[str, str] = schemas.SALARY_BANDS,
        standardise: str = "domain",
    ):
        self.tables, self.domains, self.bands, self.standardise = tables, domains, bands, standardise

    # Rules. A rule on an unknown reference reads the marker column that the checked frame carries.

    def employee_rules(self) -> list[Rule]:
        return [
            Rule("Salary range check (25k–135k)", _outside(F.col("salary"), SALARY_RANGE), "salary_out_of_range"),
            Rule("Age at hire (18–70)", _outside(F.col("age_at_hire"), AGE_RANGE), "age_at_hire_invalid"),
            Rule("Manager FK validity", F.col("unknown_manager"), "invalid_manager_id", key="manager_id"),
        ]

    def absence_rules(self) -> list[Rule]:
        return [
            Rule("Employee FK validity", F.col("unknown_employee"), "invalid_employee_id", None, "employee_id", True),
            Rule("start_date < end_date", F.col("start_date") >= F.col("end_date"), "start_after_end"),
            Rule(
                "days_absent consistency",
                F.coalesce(F.col("days_absent") != F.datediff("end_date", "start_date"), F.lit(True)),
            ),
        ]

    def recruitment_rules(self) -> list[Rule]:
        return [
            Rule("Hired employee FK validity", F.col("unknown_hire"), "invalid_hired_emp_id", key="hired_employee_id"),
            Rule(
                "date_opened < date_closed",
                F.col("date_opened") >= F.col("date_closed"),
                "date_logic_error",
                F.col("date_closed").isNotNull(),
            ),
        ]

    def leaver_rules(self) -> list[Rule]:
        return [
            Rule("Employee FK validity", F.col("hire_marker").isNull(), "invalid_employee_id"),
            Rule("leaving_date > hire_date", F.col("leaving_date") <= F.col("hire_date"), "leaving_before_hire"),
        ]

    def training_rules(self) -> list[Rule]:
        return [
            Rule("Employee FK validity", F.col("unknown_employee"), "invalid_employee_id", None, "employee_id", True),
            Rule("Internal training cost = 0", (F.col("provider") == "Internal") & (F.col("cost_eur") > 0)),
        ]

    # Frames with everything the rules read.

    @cached_property
    def checked_employees(self) -> DataFrame:
        people = self.tables.employees
        return _with_age(mark_orphans(people, "manager_id", people, "employee_id", "unknown_manager", "employee_id"))

    @cached_property
    def checked_absences(self) -> DataFrame:
        return self._with_employee_marker(self.tables.absences, "absence_id")

    @cached_property
    def checked_recruitment(self) -> DataFrame:
        return mark_orphans(
            self.tables.recruitment,
            "hired_employee_id",
            self.tables.employees,
            "employee_id",
            "unknown_hire",
            "job_req_id",
        )

    @cached_property
    def checked_leavers(self) -> DataFrame:
        # One row per employee, so that leavers never multiply: of several hire dates, the first.
        hired = self.tables.employees.groupBy("employee_id").agg(
            F.min("hire_date").alias("hire_date"), F.lit(True).alias("hire_marker")
        )
        return self.tables.leavers.join(hired, "employee_id", "left")

    @cached_property
    def checked_training(self) -> DataFrame:
        return self._with_employee_marker(self.tables.training, "training_id")

    def _with_employee_marker(self, fact, spread_by):
        return mark_orphans(fact, "employee_id", self.tables.employees, "employee_id", "unknown_employee", spread_by, True)

    # Cleaned tables: as many rows as came in.

    def employees(self) -> DataFrame:
        checked = self.checked_employees.withColumn("dq_flag", flags(self.employee_rules()))
        standard: Callable = match_domain if self.standardise == "domain" else lambda c, _: title_case(c)
        cleaned = {name: standard(F.col(name), domain) for name, domain in self.domains.items()}
        cleaned["manager_id"] = F.when(~F.col("unknown_manager"), F.col("manager_id"))
        return with_salary_band(checked.withColumns(cleaned), self.bands).drop("unknown_manager")

    def absences(self) -> DataFrame:
        return (
            self.checked_absences
            .withColumn("dq_flag", flags(self.absence_rules()))
            .withColumn("days_absent", F.datediff("end_date", "start_date"))
            .withColumn("sector_avg_absence_rate_pct", F.lit(SECTOR_ABSENCE_RATE).cast("decimal(4,1)"))
            .drop("unknown_employee")
        )

    def recruitment(self) -> DataFrame:
        return (
            self.checked_recruitment
            .withColumn("dq_flag", flags(self.recruitment_rules()))
            .withColumn("hired_employee_id", F.when(~F.col("unknown_hire"), F.col("hired_employee_id")))
            .drop("unknown_hire")
        )

    def leavers(self) -> DataFrame:
        return self.checked_leavers.withColumn("dq_flag", flags(self.leaver_rules())).drop("hire_date", "hire_marker")

    def training(self) -> DataFrame:
        kind = self.tables.training.schema["cost_eur"].dataType
        free = F.when(F.col("provider") == "Internal", F.lit(0).cast(kind)).otherwise(F.col("cost_eur"))
        return (
            self.checked_training
            .withColumn("dq_flag", flags(self.training_rules()))
            .withColumn("cost_eur", free)
            .drop("unknown_employee")
        )

    # Reports.

    def report(self) -> DataFrame:
        """The twelve checks, one pass per table."""
        t, known = self.tables, self.tables.employees.select("employee_id")
        parts = [
            ("employees", _with_age(t.employees), self.employee_rules()),
            ("absences", t.absences, self.absence_rules()),
            ("recruitment", t.recruitment, self.recruitment_rules()),
            ("leavers", self.checked_leavers, self.leaver_rules()),
            ("training", t.training, self.training_rules()),
        ]
        return union(report(df, name, rules, RESOLUTION, known) for name, df, rules in parts)


def _with_age(employees: DataFrame) -> DataFrame:
    return employees.withColumn("age_at_hire", years_between(F.col("date_of_birth"), F.col("hire_date")))


def report_totals(dq_report: DataFrame) -> DataFrame:
    """Checks run, issues found, mean clean rate."""
    return dq_report.agg(
        F.count(ROWS).alias("checks_run"),
        F.sum("issues_found").alias("issues_found"),
        F.round(F.avg(F.col("pct_clean").cast("decimal(5,2)")), 1).cast("double").alias("avg_clean_pct"),
    )
