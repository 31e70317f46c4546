"""The dashboard's measures under any filter and grouping of employees.

Every fact is added up per employee first, so grouping by any employee attribute costs one join of small rows for all facts.
Records of unknown employees, and openings without a hire, fall under NULL attributes, as a blank member does.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.functions.bands import absence_rag, absence_rag_rule, compliance_rag, pay_gap_rag
from rollcall.functions.numbers import percent, spell_score
from rollcall.operators.rollup import ROWS, attach, per_employee, stitch
from rollcall.plans.absence import INTERVIEW_DAYS, WORKING_DAYS, is_sick
from rollcall.plans.headcount import is_active
from rollcall.plans.pay import gender_pay
from rollcall.sources.schemas import FEMALE, FILLED, MALE, ONGOING


def measures(tables, by: list[str] | None = None, working_days: int = WORKING_DAYS) -> DataFrame:
    """One row of measures per group of employees; ratios are unrounded."""
    by = by or []
    one = stitch(by, _heads(tables.employees, by), gender_pay(tables.employees, by), _records(tables, by))
    counts = ["total_headcount", "active_headcount", "female_headcount", "male_headcount", "leavers_count", "covered"]
    one = one.fillna(0, subset=counts if by else [*counts, "open_vacancies"])
    c = F.col
    now, gone = c("active_headcount"), c("leavers_count")
    absence_pct = percent(c("total_sick_days"), now * working_days)
    compliance_pct = percent(c("covered"), now)
    mean_f = F.try_divide(_double("total_f"), _double("n_f"))
    mean_m = F.try_divide(_double("total_m"), _double("n_m"))
    mean_gap = F.try_divide(mean_m - mean_f, mean_m) * 100
    median_gap = F.try_divide(_double("median_m") - _double("median_f"), _double("median_m")) * 100
    return one.select(
        *by,
        "total_headcount",
        "active_headcount",
        "female_headcount",
        "male_headcount",
        F.try_divide(c("female_headcount").cast("double"), now.cast("double")).alias("pct_female"),
        "leavers_count",
        percent(gone * 2, now + gone).alias("turnover_rate_pct"),
        "total_sick_days",
        absence_pct.alias("absence_rate_pct"),
        F.try_divide(_double("score_sum"), _double("scored")).alias("bradford_factor_avg"),
        percent(c("interviews_held"), c("interviews_due")).alias("rtw_compliance_pct"),
        mean_f.alias("mean_salary_female"),
        mean_m.alias("mean_salary_male"),
        mean_gap.alias("mean_gpg_pct"),
        _double("median_f").alias("median_salary_female"),
        _double("median_m").alias("median_salary_male"),
        median_gap.alias("median_gpg_pct"),
        F.try_divide(c("fill_days"), c("fill_n")).alias("avg_time_to_fill"),
        F.try_divide(c("fill_days_academic"), c("fill_n_academic")).alias("avg_time_to_fill_academic"),
        F.try_divide(c("fill_days_support"), c("fill_n_support")).alias("avg_time_to_fill_support"),
        "open_vacancies",
        percent(c("filled"), c("openings")).alias("fill_rate_pct"),
        percent(c("training_passed"), c("training_records")).alias("training_completion_pct"),
        compliance_pct.alias("mandatory_compliance_pct"),
        _double("spend").alias("training_spend_total"),
        F.try_divide(_double("spend"), now.cast("double")).alias("training_spend_per_head"),
        compliance_rag(compliance_pct, ("Green", "Amber", "Red")).alias("training_rag"),
        absence_rag(absence_pct).alias("absence_rag"),
        absence_rag_rule(absence_pct).alias("absence_rag_rule"),
        pay_gap_rag(mean_gap).alias("pay_gap_rag"),
    )


def _double(name):
    return F.col(name).cast("double")


def _is_narrow(tables):
    return getattr(tables, "whole", None) is not None


def _facts(tables):
    """The child tables to add up per employee; of a narrowed bundle, those before the employees were narrowed."""
    return tables.whole if _is_narrow(tables) else tables


def _records(tables, by):
    """The totals of all facts by group. The facts' totals per employee go under each other, so that they meet the employees
    in one join, whatever the number of facts."""
    facts = _facts(tables)
    frames = [_leavers(facts), _absence(facts), _recruitment(facts), _training(facts)]
    people = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    if by or _is_narrow(tables):
        people = attach(people, tables.employees, by, how="inner" if _is_narrow(tables) else "left")
    sums = [F.sum(name).alias(name) for name in people.columns if name not in ("employee_id", *by)]
    return people.groupBy(*by).agg(*sums)


def _heads(employees, by):
    now = is_active()
    return employees.groupBy(*by).agg(
        F.count(ROWS).alias("total_headcount"),
        F.count_if(now).alias("active_headcount"),
        F.count_if(now & (F.col("gender") == FEMALE)).alias("female_headcount"),
        F.count_if(now & (F.col("gender") == MALE)).alias("male_headcount"),
    )


def _leavers(facts):
    return per_employee(facts.leavers, {"leavers_count": F.count(ROWS)})


def _absence(facts):
    due = is_sick() & (F.col("days_absent") >= INTERVIEW_DAYS)
    people = per_employee(
        facts.absences,
        {
            "spells": F.count(ROWS),
            "days": F.sum("days_absent"),
            "total_sick_days": F.sum(F.when(is_sick(), F.col("days_absent"))),
            "interviews_due": F.count_if(due),
            "interviews_held": F.count_if(due & F.col("return_to_work_interview")),
        },
    )
    score = spell_score(F.col("spells"), F.col("days"))
    return people.withColumn("score_sum", score).withColumn("scored", score.isNotNull().cast("int")).drop("spells", "days")


def _recruitment(facts):
    is_filled = F.col("outcome") == FILLED
    days = F.when(is_filled, F.col("time_to_fill_days"))
    roles = {"": F.lit(True), "_academic": F.col("is_academic"), "_support": ~F.col("is_academic")}
    sums = {
        "openings": F.count(ROWS),
        "filled": F.count_if(is_filled),
        "open_vacancies": F.count_if(F.col("outcome") == ONGOING),
    }
    for suffix, role in roles.items():
        sums[f"fill_days{suffix}"] = F.sum(F.when(role, days))
        sums[f"fill_n{suffix}"] = F.count(F.when(role, days))
    hired = per_employee(facts.recruitment, sums, id_col="hired_employee_id")
    return hired.withColumnRenamed("hired_employee_id", "employee_id")


def _training(facts):
    people = per_employee(
        facts.training,
        {
            "training_records": F.count(ROWS),
            "training_passed": F.count_if("passed"),
            "spend": F.sum("cost_eur"),
            "covered": F.max((F.col("mandatory") & F.col("passed")).cast("int")),
        },
    )
    # records without an employee are together one group, which is nobody's
    return people.withColumn("covered", F.when(F.col("employee_id").isNotNull(), F.col("covered")))
