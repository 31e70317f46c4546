"""Writing what other tools read: cleaned tables, the data-quality report, the KPI record and every report table."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from rollcall.plans import absence, benchmark, executive, headcount, measures, pay, recruitment, training, turnover
from rollcall.plans.cleaning import Cleaning
from rollcall.sources import benchmarks
from rollcall.sources.files import read_table, write_json_record, write_table
from rollcall.sources.tables import Workforce

TABLES = ["employees", "absences", "recruitment", "leavers", "training"]


def write_cleaned(cleaning: Cleaning, folder: str, fmt: str = "parquet") -> None:
    """The five cleaned tables, the workforce summary and the data-quality report.

    The summary is made from the employees as written, so that nothing upstream of them runs again.
    """
    tables = cleaning.tables
    for name in TABLES:
        write_table(getattr(cleaning, name)(), f"{folder}/{name}", fmt)
    employees = read_table(tables.employees.sparkSession, "employees", f"{folder}/employees", fmt)
    write_table(benchmark.workforce_summary(employees, tables.staff_profile), f"{folder}/workforce_summary", fmt)
    write_table(cleaning.report(), f"{folder}/dq_report", fmt)


def read_cleaned(spark: SparkSession, folder: str, staff_profile: DataFrame, earnings: DataFrame, fmt="parquet") -> Workforce:
    """The bundle as ``write_cleaned`` left it."""
    cleaned = {name: read_table(spark, name, f"{folder}/{name}", fmt) for name in TABLES}
    return Workforce(**cleaned, staff_profile=staff_profile, earnings=earnings)


def report_tables(tables, as_of: dt.date, first_month: dt.date, last_month: dt.date) -> dict[str, DataFrame]:
    """The tables of the management report and the dashboard, by name."""
    emp, off, rec, lev, tr = (getattr(tables, name) for name in TABLES)
    month = (first_month, last_month)
    return {
        "executive_kpis": executive.executive_kpis(tables, as_of),
        "kpi_sheet": executive.kpi_sheet(tables),
        "workforce_overview": headcount.overview(emp),
        "benchmark_comparison": benchmark.variance_listing(benchmark.workforce_summary(emp, tables.staff_profile)),
        "pay_gap": pay.pay_gap_sheet(emp),
        "pay_quartiles": pay.pay_slices(emp),
        "pay_vs_sector": pay.pay_vs_sector(emp, tables.earnings),
        "statutory_gaps": pay.statutory_gaps(emp),
        "absence_types": absence.types_summary(off),
        "spell_score_bands": absence.score_bands(off),
        "absence_heat_map": absence.rate_heat_map(emp, off),
        "recruitment_outcomes": recruitment.outcomes_by_department(rec),
        "recruitment_sources": recruitment.source_sheet(rec),
        "training": training.training_sheet(emp, tr),
        "department_status": training.department_status(emp, tr),
        "leaver_reasons": turnover.leavers_by_reason(lev),
        "leaver_destinations": turnover.leavers_by_destination(lev),
        "monthly_flow": turnover.monthly_flow(emp, lev, *month),
        "measures_by_department": measures.measures(tables, ["department"]),
        # Chart frames.
        "department_headcount": headcount.department_headcount(emp),
        "female_share_by_grade": benchmark.female_share_by_grade(emp),
        "contract_shares": headcount.contract_shares(emp),
        "turnover_by_department": turnover.active_turnover_by_department(emp, lev),
        "starters_and_leavers": turnover.monthly_flow(emp, lev, *month).drop("net_change"),
        "pay_distribution": pay.pay_distribution(emp, tables.earnings),
        "pay_levels": pay.pay_levels(emp),
        "spell_score_histogram": absence.score_histogram(off),
        "completion_by_department": training.completion_by_department(emp, tr),
        "record_compliance": training.record_compliance_by_department(emp, tr),
        "time_to_fill_spread": recruitment.time_to_fill_spread(rec),
        "source_totals": recruitment.source_totals(rec),
        "academic_headcounts": benchmark.academic_headcounts(emp, tables.staff_profile),
        # Dashboard frames.
        "sick_trend": absence.sick_trend(off, *month),
        "absence_types_by_department": absence.types_by_department(emp, off),
        "top_spell_colours": absence.top_spell_colours(emp, off),
        "top_without_training": training.top_without_mandatory_training(emp, tr, as_of),
        "mean_time_to_fill": recruitment.mean_time_to_fill(rec),
        "provider_split": training.provider_split(tr),
        "completions_by_category": training.completions_by_category(tr),
        "pay_gap_by_hire_year": pay.pay_gap_by_hire_year(emp),
        "grade_pay_ranges": headcount.grade_pay_ranges(emp),
        "pay_gap_by_grade": pay.pay_gap_by(emp, ["grade"]),
        "gender_mix": headcount.gender_mix(emp),
        "recruitment_funnel": recruitment.funnel(rec),
    }


def write_benchmarks(spark: SparkSession, folder: str, staff_profile: DataFrame, fmt: str = "parquet") -> None:
    """The benchmark tables and the provenance list, as ``read_workforce`` reads them. CSV has no lists, so the provenance
    list is written as Parquet whatever the format."""
    write_table(staff_profile, f"{folder}/staff_profile", fmt)
    write_table(benchmarks.earnings(spark), f"{folder}/earnings", fmt)
    write_table(benchmarks.pay_gap(spark), f"{folder}/pay_gap", fmt)
    write_table(benchmarks.data_sources(spark), f"{folder}/data_sources")


def write_reports(tables, folder: str, as_of: dt.date, first_month: dt.date, last_month: dt.date, fmt="parquet") -> None:
    """Every report table, and the KPI record as JSON."""
    for name, df in report_tables(tables, as_of, first_month, last_month).items():
        write_table(df, f"{folder}/{name}", fmt)
    write_json_record(executive.headline_kpis(tables).select(*executive.KPI_EXPORT), f"{folder}/kpis")
