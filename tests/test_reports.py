"""Hand-made rows for the traps of each report."""

import datetime as dt
from dataclasses import replace
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from rollcall.plans import absence, benchmark, executive, headcount, measures, pay, recruitment, training, turnover, views
from tests.conftest import day, keyed, rows

AS_OF = dt.date(2024, 12, 31)


def test_headcount_counts_every_status(table):
    emp = table(
        "employees",
        dict(department="HR", salary=Decimal("30000.00")),
        dict(department="HR", status="Retired", salary=Decimal("30001.00")),
        dict(department="IT", employment_type="Fixed-Term", status="Resigned", salary=Decimal("10.50")),
    )
    assert rows(headcount.headcount_by_contract(emp)) == [
        ("HR", "Permanent", 2, 1, 50.0, 30001.0),
        ("IT", "Fixed-Term", 1, 0, 0.0, 11.0),
    ]


def test_share_of_women_has_two_denominators(table):
    emp = table("employees", dict(gender="Female"), dict(gender="Male"), dict(gender="Non-Binary"), dict(gender=None))
    assert rows(headcount.gender_by_grade(emp), "pct_female") == [(25.0,)]
    assert rows(benchmark.female_share_by_grade(emp)) == [("Professor", 1, 1, 2, 50.0, 28.0)]


def test_grade_order_and_grades_of_one_gender(table):
    emp = table(
        "employees", dict(grade="Professor"), dict(grade="Grade 5", gender="Male"), dict(grade="Grade 7", gender="Non-Binary")
    )
    assert rows(benchmark.female_share_by_grade(emp), "grade", "pct_female", "benchmark") == [
        ("Grade 5", 0.0, None), ("Grade 7", None, None), ("Professor", 100.0, 28.0),
    ]
    assert rows(pay.pay_gap_by_grade(emp)) == []


def test_years_of_service_of_a_leap_day(table):
    emp = table("employees", dict(hire_date=day("2020-02-29")), dict(status="Retired"))
    assert rows(headcount.active_workforce(emp, day("2021-02-28")), "years_of_service") == [(0,)]
    assert len(headcount.active_workforce(emp, AS_OF).columns) == 14


def test_salary_band_of_unknown_grade(table):
    emp = table("employees", dict(grade="Professor"), dict(grade="Porter"))
    bands = keyed(headcount.with_salary_band(emp).select("grade", "benchmark_salary_band"), "grade")
    assert bands["Professor"]["benchmark_salary_band"] == "€102,000–€130,000"
    assert bands["Porter"]["benchmark_salary_band"] == "Unknown"


def test_monthly_flow_has_every_month_and_adds_up(table):
    emp = table(
        "employees", dict(hire_date=day("2020-01-31")), dict(hire_date=day("2019-12-31")), dict(hire_date=day("2020-12-31")),
        dict(hire_date=day("2021-01-01")),
    )
    lev = table("leavers", dict(leaving_date=day("2020-03-01")), dict(leaving_date=day("2020-03-31")))
    flow = rows(turnover.monthly_flow(emp, lev, day("2020-01-01"), day("2020-12-01")))
    assert len(flow) == 12 and flow[0] == ("2020-01", 1, 0, 1) and flow[2] == ("2020-03", 0, 2, -2)
    assert sum(r[1] - r[2] for r in flow) == sum(r[3] for r in flow) == 0


def test_turnover_definitions_differ(table):
    emp = table(
        "employees",
        *[dict(employee_id=f"a{i}", department="HR") for i in range(6)],
        *[dict(employee_id=f"b{i}", department="HR", status="Resigned") for i in range(2)],
        dict(employee_id="c", department="IT", status="Retired"),
        dict(employee_id="d", department="Library"),
    )
    lev = table("leavers", dict(employee_id="b0"), dict(employee_id="c"), dict(employee_id="nobody"))
    by = keyed(turnover.turnover_variants(emp, lev, ["department"]), "department")
    assert by["HR"]["leavers_per_mean_of_all"] == pytest.approx(100 * 1 / 4.5)
    assert by["HR"]["leavers_per_all"] == 12.5
    assert by["HR"]["leavers_per_active_and_leavers"] == pytest.approx(100 / 7)
    assert by["HR"]["inactive_per_all"] == 25.0
    assert by["HR"]["leavers_per_mean_of_active"] == pytest.approx(100 / 3.5)
    assert by["Library"]["leavers_per_all"] == 0.0
    chart = keyed(turnover.active_turnover_by_department(emp, lev), "department")
    # Leavers but no active staff, and the reverse, both read 0.
    assert chart["IT"]["turnover_pct"] == 0.0 and chart["Library"]["turnover_pct"] == 0.0
    assert keyed(turnover.turnover_by_department(emp, lev), "department")["IT"]["turnover_rate_pct"] == 100.0


def test_pay_gap_direction_and_absolute_order(table):
    emp = table(
        "employees",
        dict(grade="A", gender="Female", salary=Decimal("50000.00")),
        dict(grade="A", gender="Male", salary=Decimal("40000.00")),
        dict(grade="B", gender="Female", salary=Decimal("40000.00")),
        dict(grade="B", gender="Male", salary=Decimal("41000.00")),
        dict(grade="C", gender="Female", salary=Decimal("2.00")),
        dict(grade="C", gender="Male", salary=Decimal("2.00")),
    )
    assert rows(pay.pay_gap_by_grade(emp), "grade", "gpg_pct", "direction") == [
        ("A", -25.0, "Women paid more"), ("B", 2.4, "Men paid more"), ("C", 0.0, "Equal"),
    ]


def test_statutory_gaps_with_one_gender_only(table):
    got = keyed(pay.statutory_gaps(table("employees", {}, {})), "metric")
    assert got["Mean Hourly Pay Gap %"]["value_pct"] is None and got["Median Hourly Pay Gap %"]["value_pct"] is None
    assert got["Mean Bonus Gap %"]["value_pct"] == 8.5 and got["Median Bonus Gap %"]["value_pct"] == 6.2


def test_quartile_tables_with_five_people(table):
    emp = table("employees", *[dict(salary=Decimal(s), gender=g) for s, g in
                               zip((10, 10, 10, 20, 20), ("Female", "Male", "Non-Binary", "Female", "Male"))])
    bands = rows(pay.pay_quartiles(emp), "quartile_band", "total")
    slices = rows(pay.pay_slices(emp), "n")
    assert [t for _, t in bands] == [2, 1, 1, 1] and [n for (n,) in slices] == [1, 1, 1, 2]
    assert sum(t for _, t in bands) == 5


def test_slices_count_everyone_else_as_the_rest(table):
    emp = table("employees", *[dict(salary=Decimal(i), gender=g) for i, g in enumerate(("Female", "Non-Binary", "Male", "Female"), 1)])
    assert rows(pay.pay_slices(emp), "pct_f", "pct_m") == [(100.0, 0.0), (0.0, 100.0), (0.0, 100.0), (100.0, 0.0)]


def test_absence_rates_keep_people_without_absences(table):
    emp = table(
        "employees", dict(employee_id="1", department="HR"), dict(employee_id="2", department="HR"),
        dict(employee_id="3", department="IT"), dict(employee_id="4", department="HR", status="Resigned"),
    )
    off = table(
        "absences", dict(employee_id="1", days_absent=23), dict(employee_id="1", days_absent=23, absence_type="Annual Leave"),
        dict(employee_id="4", days_absent=46), dict(employee_id="9", days_absent=5),
    )
    assert rows(absence.sick_rate_by_department(emp, off)) == [("HR", 2, 23, 5.0, 4.5), ("IT", 1, 0, 0.0, 4.5)]
    assert keyed(absence.absence_rate_by_department(emp, off), "department")["HR"]["absence_rate_pct"] == 10.0
    by = keyed(absence.absence_rate_variants(emp, off, ["department"]), "department")
    assert by["HR"] == dict(sick_of_active_pct=5.0, all_of_active_pct=10.0, sick_of_everyone_pct=15.0)
    assert by["IT"] == dict(sick_of_active_pct=0.0, all_of_active_pct=0.0, sick_of_everyone_pct=0.0)


def test_interviews_are_three_valued(table):
    emp = table("employees", dict(employee_id="E1"))
    off = table(
        "absences", *[dict(return_to_work_interview=v, days_absent=d) for v, d in ((True, 3), (False, 3), (None, 4), (True, 2))]
    )
    assert rows(absence.interview_compliance(emp, off)) == [("Research", 3, 1, 1, 33.3, 95.0)]


def test_score_bands_at_their_edges(table):
    emp = table("employees", *[dict(employee_id=str(i)) for i in (99, 100, 449, 450)])
    off = table("absences", *[dict(employee_id=str(i), days_absent=i) for i in (99, 100, 449, 450)])
    assert rows(absence.score_bands(off)) == [
        ("Low (0–99)", 1, 25.0), ("Medium (100–449)", 2, 50.0), ("High (450+)", 1, 25.0),
    ]
    assert rows(absence.top_spell_scores(emp, off, 2), "employee_id", "bradford_factor", "risk_band") == [
        ("450", 450.0, "High — Review Recommended"), ("449", 449.0, "Medium"),
    ]


def test_top_scores_break_ties_by_key(table):
    emp = table("employees", *[dict(employee_id=k) for k in "dbca"])
    off = table("absences", *[dict(employee_id=k) for k in "dbca"])
    assert [r[0] for r in rows(absence.top_spell_scores(emp, off, 3), "employee_id")] == ["a", "b", "c"]


def test_heat_map_always_has_twelve_months(table):
    emp = table("employees", dict(employee_id="E1", department="HR"), dict(employee_id="E2", department="IT", status="Retired"))
    off = table("absences", dict(days_absent=23, start_date=day("2023-02-01")), dict(employee_id="E2"))
    got = keyed(absence.rate_heat_map(emp, off), "department")
    assert set(got) == {"HR"} and len(got["HR"]) == 12 and got["HR"]["Feb"] == 10.0 and got["HR"]["Dec"] == 0.0


def test_sick_trend_fills_empty_months(table):
    off = table("absences", dict(start_date=day("2023-02-28")), dict(start_date=day("2022-01-01")))
    got = keyed(absence.sick_trend(off, day("2023-01-01"), day("2023-03-01")), "year_month", "absence_type")
    assert len(got) == 6 and got["2023-02", "Certified Sick Leave"] == dict(instances=1, total_days=3)
    assert got["2023-03", "Uncertified Sick Leave"] == dict(instances=0, total_days=0)


def test_median_days_round_half_to_even(table):
    rec = table("recruitment", *[dict(time_to_fill_days=d) for d in (2, 3)], dict(time_to_fill_days=None),
                dict(outcome="Ongoing", time_to_fill_days=99))
    assert rows(recruitment.time_to_fill(rec)) == [("Research", True, 2, 3.0, 2, 3, 2)]


def test_sources_without_filled_roles(table):
    rec = table("recruitment", dict(source="X", outcome="Ongoing", time_to_fill_days=None), dict(source=None))
    got = keyed(recruitment.source_effectiveness(rec), "source")
    assert got["X"]["fill_rate_pct"] == 0.0 and got["X"]["avg_ttf_when_filled"] is None
    assert None in got and set(keyed(recruitment.source_sheet(rec), "source")) == {"X"}


def test_compliance_definitions_differ(table):
    emp = table("employees", *[dict(employee_id=k) for k in "abcd"], dict(employee_id="e", status="Resigned"))
    records = table(
        "training",
        dict(employee_id="a", course_name="Fire Safety"), dict(employee_id="a", course_name="Manual Handling"),
        dict(employee_id="a", course_name="Fire Safety"),
        dict(employee_id="b", course_name="Fire Safety"), dict(employee_id="b", course_name="Manual Handling", passed=False),
        dict(employee_id="c", course_name="Fire Safety", completion_date=day("2020-01-01")),
        dict(employee_id="d", course_name="Excel", mandatory=False),
        dict(employee_id="e", course_name="Fire Safety"),
    )
    assert rows(training.full_compliance(emp, records, AS_OF)) == [("Research", 4, 1, 25.0, 95.0, "RED")]
    got = training.compliance_variants(emp, records, AS_OF, []).first().asDict()
    assert got == dict(
        every_course_12m_pct=25.0, any_pass_12m_pct=75.0, all_records_of_all_pct=60.0,
        all_records_of_recorded_pct=75.0, any_pass_ever_pct=100.0,
    )
    assert rows(training.without_mandatory_training(emp, records, AS_OF), "employee_id", "mandatory_completions_12m") == [
        ("c", 0), ("d", 0),
    ]


def test_the_boundary_day_counts(table):
    emp = table("employees", dict(employee_id="on"), dict(employee_id="off"))
    records = table(
        "training", dict(employee_id="on", completion_date=day("2023-12-31")), dict(employee_id="off", completion_date=day("2023-12-30"))
    )
    assert rows(training.without_mandatory_training(emp, records, AS_OF), "employee_id") == [("off",)]


@pytest.mark.parametrize("passes, rag", [(19, "GREEN"), (16, "AMBER"), (15, "RED")])
def test_status_at_exactly_95_and_80(table, passes, rag):
    emp = table("employees", *[dict(employee_id=str(i)) for i in range(20)])
    records = table("training", *[dict(employee_id=str(i)) for i in range(passes)])
    assert rows(training.full_compliance(emp, records, AS_OF), "rag_status") == [(rag,)]


def test_spend_of_a_department_without_records_stays_unknown(table):
    emp = table("employees", dict(employee_id="1", department="HR"), dict(employee_id="2", department="IT"))
    records = table("training", dict(employee_id="1", cost_eur=Decimal("100.50")), dict(employee_id="1", cost_eur=Decimal("1.00")))
    got = keyed(training.spend_per_head(emp, records), "department")
    assert got["HR"]["total_training_spend_eur"] == 102.0 and got["IT"]["total_training_spend_eur"] is None


def test_no_records_is_not_compliant(table):
    emp = table("employees", dict(employee_id="1"), dict(employee_id="2"))
    records = table("training", dict(employee_id="1"), dict(employee_id="1", mandatory=False, passed=False))
    assert rows(training.record_compliance_by_department(emp, records)) == [("Research", 1, 2, 50.0, "red")]


def test_benchmark_cells_of_either_side(table):
    emp = table("employees", dict(grade="A"), dict(grade="A", status="Retired"), dict(grade="B"), dict(grade="A", gender=None))
    published = table(
        "staff_profile", dict(grade="A", headcount=3), dict(grade="A", headcount=1, contract_type="Fixed-Term", year=2024),
        dict(grade="Z", headcount=0),
    )
    compared = keyed(benchmark.benchmark_comparison(emp, published), "grade", "gender")
    assert set(compared) == {("A", "Female"), ("Z", "Female")}
    assert compared["A", "Female"]["variance_pct"] == -75.0 and compared["A", "Female"]["hea_reference_year"] == 2024
    summary = keyed(benchmark.workforce_summary(emp, published), "grade", "gender")
    assert set(summary) == {("A", "Female"), ("B", "Female"), ("Z", "Female")}
    assert summary["A", "Female"]["variance_pct"] == -50.0
    assert summary["B", "Female"]["variance_pct"] is None and summary["Z", "Female"]["variance_pct"] is None


def test_crosswalk_joins_labels_that_differ(table):
    emp = table("employees", dict(grade="Grade 5"))
    published = table("staff_profile", dict(grade="Administrator / Grade 5", headcount=1))
    assert rows(benchmark.benchmark_comparison(emp, published), "synthetic_headcount") == [(0,)]
    crosswalk = {"Administrator / Grade 5": "Grade 5"}
    assert rows(benchmark.benchmark_comparison(emp, published, crosswalk), "grade", "synthetic_headcount") == [("Grade 5", 1)]


def test_academic_labels_have_two_lines(table):
    emp = table("employees", dict(grade="Research Fellow / Postdoc"), dict(grade="Grade 5"))
    got = rows(benchmark.academic_headcounts(emp, table("staff_profile")), "label", "synthetic", "real_hea")
    assert got == [("Research Fellow\n/Postdoc\n(Female)", 1, 0)]


def test_calibration_tolerances(table):
    emp = table("employees", *[dict(gender=g) for g in ("Female", "Male", "Male", "Male")])
    published = table("staff_profile", dict(headcount=3), dict(gender="Male", headcount=7))
    got = keyed(benchmark.calibration(emp, published), "measure", "subject")
    assert got["female_share_pct", "Professor"]["diff"] == -5.0 and got["female_share_pct", "Professor"]["ok"]
    assert not got["headcount_pct_of_published", "Professor / Male"]["ok"]
    assert got["permanent_share_pct", "all"]["ok"]


def small(bundle):
    return bundle(
        employees=[
            dict(employee_id="1", department="HR", salary=Decimal("40000.00"), hire_date=day("2020-05-01")),
            dict(employee_id="2", department="HR", gender="Male", salary=Decimal("50000.00"), hire_date=day("2021-05-01")),
            dict(employee_id="3", department="IT", gender="Male", salary=Decimal("60000.00"), status="Resigned"),
            dict(employee_id="4", department="IT", gender="Non-Binary", hire_date=day("2021-01-01")),
        ],
        absences=[
            dict(employee_id="1", days_absent=3), dict(employee_id="1", days_absent=2, absence_type="Annual Leave"),
            dict(employee_id="2", days_absent=5, return_to_work_interview=None), dict(employee_id="x", days_absent=9),
        ],
        recruitment=[
            dict(hired_employee_id="1", time_to_fill_days=10), dict(hired_employee_id="4", time_to_fill_days=20, is_academic=False),
            dict(outcome="Ongoing", time_to_fill_days=None),
        ],
        leavers=[dict(employee_id="3")],
        training=[dict(employee_id="1", cost_eur=Decimal("10.00")), dict(employee_id="2", passed=False, completion_date=day("2019-01-01"))],
    )


def test_measures_by_department_have_a_blank_member(bundle):
    got = keyed(measures.measures(small(bundle), ["department"]), "department")
    assert set(got) == {"HR", "IT", None}
    hr = got["HR"]
    assert (hr["total_headcount"], hr["pct_female"], hr["total_sick_days"]) == (2, 0.5, 8)
    assert hr["bradford_factor_avg"] == (4 * 5 + 1 * 5) / 2 and hr["rtw_compliance_pct"] == 50.0
    assert hr["mean_gpg_pct"] == 20.0 and hr["pay_gap_rag"] == "Red" and hr["avg_time_to_fill"] == 10.0
    assert hr["training_completion_pct"] == 50.0 and hr["mandatory_compliance_pct"] == 50.0
    assert got["IT"]["turnover_rate_pct"] == 100.0 and got["IT"]["mean_gpg_pct"] is None
    assert got[None]["open_vacancies"] == 1 and got[None]["total_sick_days"] == 9 and got[None]["total_headcount"] == 0


def test_measures_total_and_slicers(bundle):
    tables = small(bundle)
    whole = measures.measures(tables).first()
    assert (whole.total_headcount, whole.active_headcount, whole.total_sick_days) == (4, 3, 17)
    assert whole.fill_rate_pct == pytest.approx(200 / 3) and whole.avg_time_to_fill_support == 20.0
    sliced = tables.sliced(employees=F.year("hire_date") == 2021, absences=F.col("absence_type") != "Annual Leave")
    part = measures.measures(sliced).first()
    assert (part.total_headcount, part.total_sick_days, part.leavers_count) == (2, 5, 0)
    assert part.avg_time_to_fill == 20.0 and part.open_vacancies == 0


def test_executive_lists(bundle):
    tables = small(bundle)
    kpis = dict(rows(executive.executive_kpis(tables, AS_OF), "kpi", "value"))
    assert len(kpis) == 9 and kpis["Total Headcount"] == "4" and kpis["Turnover Rate %"] == "25.0"
    assert kpis["Absence Rate % (Sick)"] == "2.46" and kpis["Mandatory Training Compliance %"] == "33.3"
    assert kpis["Avg Time to Fill — Academic (days)"] == "10"
    sheet = dict(rows(executive.kpi_sheet(tables), "kpi", "value"))
    assert len(sheet) == 10 and sheet["Turnover Rate %"] == "25.0%" and sheet["Avg Time to Fill (Support)"] == "20 days"
    record = executive.kpi_export(tables).first().record
    assert record.startswith('{"total_headcount":4,"active_headcount":3,"turnover_rate_pct":25.0')


def test_reports_on_empty_tables(bundle):
    tables = bundle()
    assert rows(executive.executive_kpis(tables, AS_OF), "value")[0] == ("0",)
    assert executive.headline_kpis(tables).first().turnover_rate_pct is None
    assert rows(pay.pay_quartiles(tables.employees)) == [] and rows(absence.top_spell_scores(tables.employees, tables.absences)) == []
    assert measures.measures(tables, ["department"]).count() == 0


def test_repeated_rows_are_counted_once_where_the_sql_counts_distinct(bundle):
    tables = bundle(
        employees=[dict(employee_id="1"), dict(employee_id="1"), dict(employee_id="2", department="IT")],
        absences=[dict(employee_id="2", absence_id="A", days_absent=5), dict(employee_id="2", absence_id="A", days_absent=5)],
        leavers=[dict(employee_id="1"), dict(employee_id="1")],
        training=[dict(employee_id="1", cost_eur=Decimal("10.00"))],
    )
    emp, off, lev, tr = tables.employees, tables.absences, tables.leavers, tables.training
    top = absence.top_spell_scores(emp, off).first()
    assert (top.spells, top.total_days_absent, top.bradford_factor) == (1, 10, 10.0)
    assert rows(turnover.turnover_by_department(emp, lev), "department", "total_headcount", "total_leavers") == [
        ("Research", 1, 1), ("IT", 1, 0),
    ]
    assert dict(rows(absence.sick_rate_by_department(emp, off), "department", "active_headcount")) == {"Research": 1, "IT": 1}
    spend = keyed(training.spend_per_head(emp, tr), "department")["Research"]
    assert (spend["active_headcount"], spend["total_training_spend_eur"]) == (1, 20.0)


def test_a_sliced_bundle_measures_as_its_rows_do(bundle):
    tables = small(bundle)
    for department in ("HR", "nowhere"):
        part = tables.sliced(employees=F.col("department") == department, absences=F.col("days_absent") > 2)
        part = part.sliced(training=F.col("passed"))
        by_rows = replace(part, whole=None)
        for by in ([], ["department"]):
            assert rows(measures.measures(part, by)) == rows(measures.measures(by_rows, by))


def test_views_by_name(bundle, spark):
    tables = bundle(employees=[{}, dict(status="Resigned")], absences=[dict(employee_id="E1", days_absent=4)])
    views.register_views(tables, day("2024-12-31"))
    assert spark.sql("SELECT count(*) FROM v_active_workforce").first()[0] == 1
    assert rows(spark.sql("SELECT department, headcount, total_days_absent FROM v_absence_rate_by_dept")) == [("Research", 1, 4)]


def test_a_pass_without_an_employee_covers_nobody(bundle):
    tables = bundle(
        employees=[dict(employee_id="1"), dict(employee_id="2")],
        training=[dict(employee_id="1"), dict(employee_id="1"), dict(employee_id=None), dict(employee_id="2", passed=False)],
    )
    for by in (None, ["department"]):
        got = [r for r in measures.measures(tables, by).collect() if not by or r["department"]]
        assert [r["mandatory_compliance_pct"] for r in got] == [50.0]
