"""Headline KPIs: one aggregate per table, put side by side, then listed as rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.functions.numbers import HALF_EVEN, HALF_UP, gap_percent, mean, percent, text_number
from rollcall.operators.kpis import as_rows
from rollcall.operators.rollup import ROWS, stitch
from rollcall.plans.absence import WORKING_DAYS, is_sick
from rollcall.plans.headcount import is_active
from rollcall.plans.pay import gender_pay, pay_of
from rollcall.plans.recruitment import outcome_count
from rollcall.plans.training import every_record_passed, recent_passes
from rollcall.sources.schemas import FEMALE, FILLED, MALE, ONGOING


def _days_to_fill(academic):
    wanted = (F.col("outcome") == FILLED) & (F.col("is_academic") == F.lit(academic))
    return mean(F.when(wanted, F.col("time_to_fill_days")))


def _openings(recruitment):
    return recruitment.agg(
        outcome_count(ONGOING).alias("open_vacancies"),
        _days_to_fill(True).alias("ttf_academic"),
        _days_to_fill(False).alias("ttf_support"),
    )


def _sick_days(absences):
    return absences.filter(is_sick()).agg(F.sum("days_absent").alias("sick_days"))


def executive_kpis(tables, as_of: dt.date, working_days: int = WORKING_DAYS) -> DataFrame:
    """The nine headline figures as text, each with its benchmark."""
    now_pay = {g: mean(F.when(is_active(), pay_of(g))) for g in (FEMALE, MALE)}
    people = tables.employees.agg(
        F.count("employee_id").alias("heads"),
        F.count_if(is_active()).alias("now"),
        now_pay[FEMALE].alias("mean_f"),
        now_pay[MALE].alias("mean_m"),
    )
    covered = recent_passes(tables.training, as_of).select("employee_id").distinct()
    one = stitch(
        [],
        people,
        tables.leavers.agg(F.count(ROWS).alias("gone")),
        _sick_days(tables.absences),
        _openings(tables.recruitment),
        covered.agg(F.count("employee_id").alias("covered")),
    )
    c = F.col
    return as_rows(
        one,
        ["kpi", "value", "benchmark"],
        [
            ("Total Headcount", c("heads").cast("string"), "FTE basis: HEA 2023 ~2,800"),
            ("Active Headcount", c("now").cast("string"), "Status = Active"),
            ("Turnover Rate %", text_number(percent(c("gone"), c("heads"), 1), 1), "Irish HEI avg ~8–12%"),
            (
                "Absence Rate % (Sick)",
                text_number(percent(c("sick_days"), c("now") * working_days, 2), 2),
                "Public sector benchmark ~4.5%",
            ),
            (
                "Mean Gender Pay Gap %",
                text_number(gap_percent(c("mean_m"), c("mean_f"), 1), 1),
                "Irish HEI benchmark ~16.2%",
            ),
            ("Open Vacancies", c("open_vacancies").cast("string"), "Outcome = Ongoing"),
            (
                "Mandatory Training Compliance %",
                text_number(percent(c("covered"), c("now"), 1), 1),
                "Target: 95%",
            ),
            (
                "Avg Time to Fill — Academic (days)",
                text_number(HALF_UP(c("ttf_academic"), 0), 0),
                "Target: <90 days",
            ),
            (
                "Avg Time to Fill — Support (days)",
                text_number(HALF_UP(c("ttf_support"), 0), 0),
                "Target: <45 days",
            ),
        ],
    )


def headline_kpis(tables, working_days: int = WORKING_DAYS) -> DataFrame:
    """Eleven figures in one row. Turnover is inactive over all; compliance counts people with records only."""
    people = tables.employees.agg(F.count(ROWS).alias("heads"), F.count_if(is_active()).alias("now"))
    compliant = every_record_passed(tables.training).agg(
        F.count_if("compliant").alias("compliant"), F.count("compliant").alias("recorded")
    )
    one = stitch(
        [],
        people,
        gender_pay(tables.employees),
        _sick_days(tables.absences),
        _openings(tables.recruitment),
        compliant,
    )
    c = F.col
    return one.select(
        c("heads").alias("total_headcount"),
        c("now").alias("active_headcount"),
        (c("heads") - c("now")).alias("inactive_headcount"),
        percent(c("heads") - c("now"), c("heads"), 1, HALF_EVEN).alias("turnover_rate_pct"),
        percent(F.coalesce("sick_days", F.lit(0)), c("now") * working_days, 2, HALF_EVEN).alias("absence_rate_pct"),
        gap_percent(c("mean_m"), c("mean_f"), 1, HALF_EVEN).alias("mean_gpg_pct"),
        gap_percent(c("median_m"), c("median_f"), 1, HALF_EVEN).alias("median_gpg_pct"),
        "open_vacancies",
        percent(c("compliant"), c("recorded"), 1, HALF_EVEN).alias("mandatory_training_compliance_pct"),
        HALF_EVEN(c("ttf_academic"), 0).cast("bigint").alias("avg_ttf_academic_days"),
        HALF_EVEN(c("ttf_support"), 0).cast("bigint").alias("avg_ttf_support_days"),
    )


def kpi_sheet(tables, working_days: int = WORKING_DAYS) -> DataFrame:
    """Ten of the headline figures as text with their context."""
    c = F.col

    def pct(column):
        return F.concat(column.cast("string"), F.lit("%"))

    def days(column):
        return F.concat(column.cast("string"), F.lit(" days"))

    share = percent(c("active_headcount"), c("total_headcount"), 1, HALF_EVEN)
    return as_rows(
        headline_kpis(tables, working_days),
        ["kpi", "value", "benchmark"],
        [
            ("Total Headcount", c("total_headcount").cast("string"), "HEA 2023: ~3,400"),
            ("Active Staff", c("active_headcount").cast("string"), F.concat(pct(share), F.lit(" of total"))),
            ("Turnover Rate %", pct(c("turnover_rate_pct")), "Irish HEI avg ~8–12%"),
            ("Absence Rate (sick) %", pct(c("absence_rate_pct")), "Irish public sector norm ~4.5%"),
            ("Mean Gender Pay Gap %", pct(c("mean_gpg_pct")), "Irish HEI benchmark ~16.2% (men paid more)"),
            ("Median Gender Pay Gap %", pct(c("median_gpg_pct")), "Irish HEI benchmark ~12.8%"),
            ("Open Vacancies", c("open_vacancies").cast("string"), "Ongoing recruitment"),
            ("Mandatory Training Compliance %", pct(c("mandatory_training_compliance_pct")), "Target: 95%"),
            ("Avg Time to Fill (Academic)", days(c("avg_ttf_academic_days")), "Typical: 60–120 days"),
            ("Avg Time to Fill (Support)", days(c("avg_ttf_support_days")), "Typical: 30–60 days"),
        ],
    )


KPI_EXPORT = [
    "total_headcount",
    "active_headcount",
    "turnover_rate_pct",
    "absence_rate_pct",
    "mean_gpg_pct",
    "median_gpg_pct",
    "mandatory_training_compliance_pct",
    "avg_ttf_academic_days",
    "avg_ttf_support_days",
]


def kpi_export(tables, working_days: int = WORKING_DAYS) -> DataFrame:
    """The nine exported figures as one JSON record."""
    one = headline_kpis(tables, working_days)
    return one.select(F.to_json(F.struct(*KPI_EXPORT)).alias("record"))


