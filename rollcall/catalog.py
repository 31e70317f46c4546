"""Every report by name, over the workforce tables that ``RoleTables`` derives."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.operators.quality import duplicate_keys
from rollcall.plans import (
    absence,
    benchmark,
    constraints,
    executive,
    headcount,
    measures,
    pay,
    recruitment,
    training,
    turnover,
    views,
)
from rollcall.plans.cleaning import Cleaning, report_totals
from rollcall.sources import files, roles, schemas
from rollcall.sources.roles import AS_OF, FIRST_MONTH, LAST_MONTH, RoleTables

# The derived tables use their own words, so the word lists of a report are given here.
GRADES = tuple(f"NATION_{i}" for i in range(25))
SHARES = {"NATION_3": 28, "NATION_14": 35, "NATION_15": 42, "NATION_9": 52, "NATION_23": 48}
CHART_GRADES = ("NATION_3", "NATION_14", "NATION_15", "NATION_9", "NATION_23")
CROSSWALK = {"NATION_20": "NATION_22", "NATION_21": "NATION_23"}
DOMAINS = {
    "gender": schemas.GENDERS,
    "employment_type": schemas.EMPLOYMENT_TYPES,
    "status": schemas.STATUSES,
    "department": (),
    "campus": roles.CAMPUSES,
}
ID_PATTERNS = {
    "employee_id": r"^\d{3}$",
    "absence_id": r"^\d{4}$",
    "job_req_id": r"^\d{1,4}$",
    "training_id": r"^\d{1,4}-\d$",
}
COURSES = ("PROMO Brand#1", "PROMO Brand#2", "PROMO Brand#3", "SMALL Brand#1", "SMALL Brand#2")
ACADEMIC = ("BUILDING", "MACHINERY")
PEOPLE = ("employee_id", "hire_date", "department", "grade", "salary", "manager_id", "campus", "status", "is_academic")
SPELLS = ("absence_id", "employee_id", "absence_type", "start_date", "days_absent", "approved", "return_to_work_interview")
COURSE_RECORDS = ("training_id", "employee_id", "course_name", "provider", "completion_date", "passed")


def _cleaning(t, standardise="domain"):
    return Cleaning(t, DOMAINS, roles.GRADE_BANDS, standardise)


def _business_rules():
    return constraints.business_rules(ID_PATTERNS, COURSES, ACADEMIC)


def _sliced(t: RoleTables):
    chosen = (F.year("hire_date") == 1995) & (F.col("employment_type") != "Part-Time") & (F.col("gender") != "Male")
    return t.workforce().sliced(
        employees=chosen & F.col("department").isin("BUILDING", "MACHINERY", "HOUSEHOLD"),
        absences=F.col("absence_type") == "Certified Sick Leave",
        training=F.col("provider") == "External",
    )


def _defaults(t, name):
    """A table's key and the columns that have a declared default."""
    filled = constraints.with_defaults(getattr(t, name), name)
    return filled.select(constraints.PRIMARY_KEYS[name], *constraints.DEFAULTS[name])


def _view(t, query):
    """A query over the named views, as SQL users ask them."""
    views.register_views(t, AS_OF)
    return t.spark.sql(query)


REPORTS: dict[str, Callable[[RoleTables], DataFrame]] = {
    # Numbered business queries and views.
    "K1_headcount_by_contract": lambda t: headcount.headcount_by_contract(t.employees),
    "K2_gender_by_grade": lambda t: headcount.gender_by_grade(t.employees),
    "K3_benchmark_comparison": lambda t: benchmark.benchmark_comparison(t.employees, t.staff_profile),
    "K3_benchmark_comparison_crosswalk": lambda t: benchmark.benchmark_comparison(
        t.employees, t.staff_profile, CROSSWALK
    ),
    "K4_monthly_flow": lambda t: turnover.monthly_flow(t.employees, t.leavers, FIRST_MONTH, LAST_MONTH),
    "K5_turnover_by_department": lambda t: turnover.turnover_by_department(t.employees, t.leavers),
    "K6_pay_by_gender": lambda t: pay.pay_by_gender(t.employees),
    "K7_pay_gap_by_grade": lambda t: pay.pay_gap_by_grade(t.employees),
    "K8_pay_vs_sector": lambda t: pay.pay_vs_sector(t.employees, t.earnings),
    "K9_sick_rate_by_department": lambda t: absence.sick_rate_by_department(t.employees, t.absences),
    "K10_sick_leave_breakdown": lambda t: absence.sick_leave_breakdown(t.employees, t.absences),
    "K11_top_spell_scores": lambda t: absence.top_spell_scores(t.employees, t.absences),
    "K12_interview_compliance": lambda t: absence.interview_compliance(t.employees, t.absences),
    "K13_time_to_fill": lambda t: recruitment.time_to_fill(t.recruitment),
    "K14_source_effectiveness": lambda t: recruitment.source_effectiveness(t.recruitment),
    "K15_completion_by_category": lambda t: training.completion_by_category(t.employees, t.training),
    "K16_full_compliance": lambda t: training.full_compliance(t.employees, t.training, AS_OF),
    "K17_spend_per_head": lambda t: training.spend_per_head(t.employees, t.training),
    "K18_without_mandatory_training": lambda t: training.without_mandatory_training(t.employees, t.training, AS_OF),
    "K19a_statutory_gaps": lambda t: pay.statutory_gaps(t.employees),
    "K19b_pay_quartiles": lambda t: pay.pay_quartiles(t.employees),
    "K20_executive_kpis": lambda t: executive.executive_kpis(t, AS_OF),
    "V1_active_workforce": lambda t: headcount.active_workforce(
        headcount.with_salary_band(t.employees, roles.GRADE_BANDS), AS_OF
    ),
    "V2_absence_rate_by_department": lambda t: absence.absence_rate_by_department(t.employees, t.absences),
    "S11_active_view": lambda t: _view(
        t,
        "SELECT department, gender, count(*) AS heads, min(hire_date) AS first_hire, max(years_of_service) AS longest "
        "FROM v_active_workforce GROUP BY department, gender",
    ),
    "S11_absence_view": lambda t: _view(t, "SELECT * FROM v_absence_rate_by_dept WHERE headcount > 0"),
    "W1_quartile_of_employees": lambda t: pay.quartile_of_employees(t.employees),
    # Merge and chart frames.
    "B1_workforce_summary": lambda t: benchmark.workforce_summary(t.employees, t.staff_profile),
    "C1_department_headcount": lambda t: headcount.department_headcount(t.employees),
    "C2_female_share_by_grade": lambda t: benchmark.female_share_by_grade(t.employees, GRADES, SHARES),
    "C3_contract_shares": lambda t: headcount.contract_shares(t.employees),
    "C4_active_turnover": lambda t: turnover.active_turnover_by_department(t.employees, t.leavers),
    "C5_starters_and_leavers": lambda t: turnover.monthly_flow(t.employees, t.leavers, FIRST_MONTH, LAST_MONTH).drop(
        "net_change"
    ),
    "C6_rate_heat_map": lambda t: absence.rate_heat_map(t.employees, t.absences),
    "C7_pay_distribution": lambda t: pay.pay_distribution(t.employees, t.earnings, GRADES),
    "C8_pay_levels": lambda t: pay.pay_levels(t.employees),
    "C9_score_histogram": lambda t: absence.score_histogram(t.absences),
    "C10_completion_by_department": lambda t: training.completion_by_department(t.employees, t.training),
    "C11_record_compliance": lambda t: training.record_compliance_by_department(t.employees, t.training),
    "C12_time_to_fill_spread": lambda t: recruitment.time_to_fill_spread(t.recruitment),
    "C13_source_totals": lambda t: recruitment.source_totals(t.recruitment),
    "C14_academic_headcounts": lambda t: benchmark.academic_headcounts(t.employees, t.staff_profile, CHART_GRADES),
    # KPI and report tables.
    "X0_headline_kpis": executive.headline_kpis,
    "X1_kpi_sheet": executive.kpi_sheet,
    "X2_overview": lambda t: headcount.overview(t.employees),
    "X3_variance_listing": lambda t: benchmark.variance_listing(
        benchmark.workforce_summary(t.employees, t.staff_profile)
    ),
    "X4a_pay_gap_sheet": lambda t: pay.pay_gap_sheet(t.employees),
    "X4b_pay_slices": lambda t: pay.pay_slices(t.employees),
    "X5a_types_summary": lambda t: absence.types_summary(t.absences),
    "X5b_score_bands": lambda t: absence.score_bands(t.absences),
    "X6a_outcomes_by_department": lambda t: recruitment.outcomes_by_department(t.recruitment),
    "X6b_source_sheet": lambda t: recruitment.source_sheet(t.recruitment),
    "X7_training_sheet": lambda t: training.training_sheet(t.employees, t.training),
    "X8a_leavers_by_reason": lambda t: turnover.leavers_by_reason(t.leavers),
    "X8b_leavers_by_destination": lambda t: turnover.leavers_by_destination(t.leavers),
    "X9_kpi_export": executive.kpi_export,
    # Definitions of one metric side by side.
    "T_turnover_variants": lambda t: turnover.turnover_variants(t.employees, t.leavers, ["department"]),
    "T_absence_rate_variants": lambda t: absence.absence_rate_variants(t.employees, t.absences, ["department"]),
    "T_compliance_variants": lambda t: training.compliance_variants(t.employees, t.training, AS_OF, ["department"]),
    # Dashboard measures and frames.
    "M_measures_total": lambda t: measures.measures(t),
    "M_measures_by_department": lambda t: measures.measures(t, ["department"]),
    "M_measures_by_grade_and_role": lambda t: measures.measures(t, ["grade", "is_academic"]),
    "P12_measures_sliced": lambda t: measures.measures(_sliced(t), ["campus", "gender"]),
    "G1_sick_trend": lambda t: absence.sick_trend(t.absences, FIRST_MONTH, LAST_MONTH),
    "G2_types_by_department": lambda t: absence.types_by_department(t.employees, t.absences),
    "G3a_top_spell_colours": lambda t: absence.top_spell_colours(t.employees, t.absences),
    "G3b_top_without_training": lambda t: training.top_without_mandatory_training(t.employees, t.training, AS_OF),
    "G4_mean_time_to_fill": lambda t: recruitment.mean_time_to_fill(t.recruitment),
    "G5_provider_split": lambda t: training.provider_split(t.training),
    "G5_completions_by_category": lambda t: training.completions_by_category(t.training),
    "G6_pay_gap_by_hire_year": lambda t: pay.pay_gap_by_hire_year(t.employees),
    "G7_grade_pay_ranges": lambda t: headcount.grade_pay_ranges(t.employees, roles.GRADE_BANDS),
    "G8_pay_gap_by_grade_only": lambda t: pay.pay_gap_by(t.employees, ["grade"]),
    "G9_gender_mix": lambda t: headcount.gender_mix(t.employees),
    "G10_funnel": lambda t: recruitment.funnel(t.recruitment),
    "G11_department_status": lambda t: training.department_status(t.employees, t.training),
    # Data quality.
    "D_clean_employees": lambda t: _cleaning(t).employees(),
    "D_clean_absences": lambda t: _cleaning(t).absences(),
    "D_clean_recruitment": lambda t: _cleaning(t).recruitment(),
    "D_clean_leavers": lambda t: _cleaning(t).leavers(),
    "D_clean_training": lambda t: _cleaning(t).training(),
    "D4_title_case": lambda t: _cleaning(t, "title").employees().select("employee_id", *DOMAINS),
    "D16_report": lambda t: _cleaning(t).report(),
    "D17_report_totals": lambda t: report_totals(_cleaning(t).report()),
    "D18_key_summary": constraints.key_summary,
    "D18_repeated_training_ids": lambda t: duplicate_keys(t.training, "training_id"),
    "D19_orphan_summary": constraints.orphan_summary,
    "D20_D22_check_violations": lambda t: constraints.count_violations(
        t, constraints.domain_rules(roles.CAMPUSES), constraints.range_rules()
    ),
    "D20_length_violations": lambda t: constraints.count_violations(
        t, {name: constraints.length_rules(name, getattr(t, name)) for name in schemas.TEXT_LENGTHS}
    ),
    "D23_required_values": lambda t: constraints.count_violations(t, constraints.required_rules(t)),
    "D23_defaults": lambda t: _defaults(t, "absences"),
    "D23_defaults_employees": lambda t: _defaults(t, "employees"),
    "D23_defaults_recruitment": lambda t: _defaults(t, "recruitment"),
    "D23_defaults_leavers": lambda t: _defaults(t, "leavers"),
    "D23_defaults_training": lambda t: _defaults(t, "training"),
    "D24_set_null": lambda t: constraints.set_null_where_unknown(
        t.recruitment, "hired_employee_id", headcount.active(t.employees), "job_req_id"
    ).select("job_req_id", "outcome", "hired_employee_id"),
    "D25_business_rules": lambda t: constraints.count_violations(t, _business_rules()),
    "D25_tenure": constraints.tenure_mismatches,
    "D26_calibration": lambda t: benchmark.calibration(t.employees, t.staff_profile),
    # Sources.
    "S1_employees_by_csv": lambda t: files.round_trip(t.employees.select(*PEOPLE), "employees", "csv"),
    "S1_absences_by_csv": lambda t: files.round_trip(t.absences.select(*SPELLS), "absences", "csv"),
    "S2_workforce_summary_by_csv": lambda t: files.round_trip(
        benchmark.workforce_summary(t.employees, t.staff_profile), "workforce_summary", "csv"
    ),
    "S7_cleaned_leavers_by_parquet": lambda t: files.round_trip(_cleaning(t).leavers(), "leavers"),
    "S8_training_by_provider_folder": lambda t: files.round_trip(
        t.training.select(*COURSE_RECORDS), "training", partition_by=["provider"]
    ),
    "P9_mandatory_courses": lambda t: training.mandatory_courses(t.training),
    "S10_row_counts": lambda t: files.row_counts(
        {
            "employees": t.employees,
            "absences": t.absences,
            "recruitment": t.recruitment,
            "leavers": t.leavers,
            "training": t.training,
            "workforce_summary": benchmark.workforce_summary(t.employees, t.staff_profile),
        }
    ),
}
