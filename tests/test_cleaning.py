from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from rollcall.operators import quality
from rollcall.plans import constraints
from rollcall.plans.cleaning import Cleaning, report_totals
from rollcall.sources import benchmarks
from tests.conftest import day, keyed, rows


@pytest.fixture()
def dirty(bundle):
    return bundle(
        employees=[
            dict(employee_id="1", salary=Decimal("25000.00"), department="IT", campus=" galway main "),
            dict(employee_id="2", salary=Decimal("24999.99"), manager_id="1", department=" hr", status="End of Contract"),
            dict(employee_id="3", manager_id="gone", date_of_birth=day("2010-01-01"), employment_type=" fixed-term "),
            dict(employee_id="4", salary=Decimal("135000.01"), manager_id="gone", date_of_birth=None, gender=None),
        ],
        absences=[
            dict(employee_id="1"),
            dict(employee_id="nobody", days_absent=7),
            dict(employee_id="2", start_date=day("2023-03-01"), end_date=day("2023-03-01"), days_absent=0),
            dict(employee_id="2", days_absent=None),
        ],
        recruitment=[
            dict(hired_employee_id="1"),
            dict(hired_employee_id="gone"),
            dict(date_closed=day("2022-03-01")),
            dict(date_closed=None, outcome="Ongoing", time_to_fill_days=None),
        ],
        leavers=[dict(employee_id="2"), dict(employee_id="3", leaving_date=day("2020-01-15")), dict(employee_id="gone")],
        training=[
            dict(employee_id="1", cost_eur=Decimal("5.00")),
            dict(employee_id="1", provider="External", cost_eur=Decimal("5.00")),
            dict(employee_id="gone"),
        ],
    )


def test_employee_flags_and_repairs(dirty):
    got = keyed(Cleaning(dirty).employees(), "employee_id")
    assert {k: v["dq_flag"] for k, v in got.items()} == {
        "1": "",
        "2": "salary_out_of_range;",
        "3": "age_at_hire_invalid;invalid_manager_id;",
        "4": "salary_out_of_range;invalid_manager_id;",
    }
    assert got["2"]["manager_id"] == "1" and got["3"]["manager_id"] is None
    assert got["1"]["campus"] == "Galway Main" and got["2"]["department"] == "HR" and got["3"]["employment_type"] == "Fixed-Term"
    assert got["2"]["status"] == "End of Contract" and got["4"]["gender"] is None
    assert got["1"]["age_at_hire"] == pytest.approx(14624 / 365.25) and got["4"]["age_at_hire"] is None


def test_title_case_is_kept_for_parity(dirty):
    got = keyed(Cleaning(dirty, standardise="title").employees(), "employee_id")
    assert got["1"]["department"] == "It" and got["2"]["status"] == "End Of Contract"


def test_other_tables(dirty):
    clean = Cleaning(dirty)
    off = keyed(clean.absences(), "absence_id")
    assert [off[f"A{i}"]["dq_flag"] for i in (1, 2, 3, 4)] == ["", "invalid_employee_id;", "start_after_end;", ""]
    assert [off[f"A{i}"]["days_absent"] for i in (1, 2, 3, 4)] == [3, 3, 0, 3]
    assert off["A2"]["employee_id"] == "nobody" and off["A1"]["sector_avg_absence_rate_pct"] == Decimal("4.5")
    rec = keyed(clean.recruitment(), "job_req_id")
    assert [rec[f"R{i}"]["dq_flag"] for i in (1, 2, 3, 4)] == ["", "invalid_hired_emp_id;", "date_logic_error;", ""]
    assert rec["R1"]["hired_employee_id"] == "1" and rec["R2"]["hired_employee_id"] is None
    lev = keyed(clean.leavers(), "employee_id")
    assert {k: v["dq_flag"] for k, v in lev.items()} == {"2": "", "3": "leaving_before_hire;", "gone": "invalid_employee_id;"}
    tr = keyed(clean.training(), "training_id")
    assert [tr[f"T{i}"]["cost_eur"] for i in (1, 2, 3)] == [0, 5, 0] and tr["T3"]["dq_flag"] == "invalid_employee_id;"


def test_report_agrees_with_the_flags_and_keeps_rows(dirty):
    clean = Cleaning(dirty)
    report = keyed(clean.report(), "table", "check")
    assert len(report) == 12
    tokens = {
        ("employees", "Salary range check (25k–135k)"): "salary_out_of_range",
        ("employees", "Age at hire (18–70)"): "age_at_hire_invalid",
        ("employees", "Manager FK validity"): "invalid_manager_id",
        ("absences", "Employee FK validity"): "invalid_employee_id",
        ("absences", "start_date < end_date"): "start_after_end",
        ("recruitment", "Hired employee FK validity"): "invalid_hired_emp_id",
        ("recruitment", "date_opened < date_closed"): "date_logic_error",
        ("leavers", "Employee FK validity"): "invalid_employee_id",
        ("leavers", "leaving_date > hire_date"): "leaving_before_hire",
        ("training", "Employee FK validity"): "invalid_employee_id",
    }
    for (name, check), token in tokens.items():
        flagged = getattr(clean, name)().filter(F.contains("dq_flag", F.lit(token))).count()
        assert report[name, check]["issues_found"] == flagged, (name, check)
    assert report["absences", "days_absent consistency"]["issues_found"] == 2
    assert report["training", "Internal training cost = 0"]["issues_found"] == 1
    assert report["recruitment", "date_opened < date_closed"]["total_rows"] == 3
    for name in ("employees", "absences", "recruitment", "leavers", "training"):
        assert getattr(clean, name)().count() == getattr(dirty, name).count()
    totals = report_totals(clean.report()).first()
    assert totals.checks_run == 12 and totals.issues_found == sum(r["issues_found"] for r in report.values())


def test_missing_employees_count_where_the_reference_is_required(bundle):
    tables = bundle(
        employees=[dict(employee_id="1", manager_id=None)],
        absences=[dict(employee_id=None), dict(employee_id="1")],
        recruitment=[dict(hired_employee_id=None)],
        training=[dict(employee_id=None)],
    )
    clean = Cleaning(tables)
    report = {k: v["issues_found"] for k, v in keyed(clean.report(), "table", "check").items()}
    assert report["absences", "Employee FK validity"] == 1 and report["training", "Employee FK validity"] == 1
    assert report["employees", "Manager FK validity"] == 0 and report["recruitment", "Hired employee FK validity"] == 0
    assert keyed(clean.absences(), "absence_id")["A1"]["dq_flag"] == "invalid_employee_id;"
    assert keyed(clean.training(), "training_id")["T1"]["dq_flag"] == "invalid_employee_id;"


def test_leavers_never_multiply(bundle):
    tables = bundle(
        employees=[dict(employee_id="1", hire_date=day("2021-01-01")), dict(employee_id="1", hire_date=day("2019-01-01"))],
        leavers=[dict(employee_id="1", leaving_date=day("2020-06-01"))],
    )
    clean = Cleaning(tables)
    assert rows(clean.leavers(), "employee_id", "dq_flag") == [("1", "")]
    assert keyed(clean.report(), "table", "check")["leavers", "Employee FK validity"]["total_rows"] == 1


def test_nothing_to_check_is_not_passed_over(bundle):
    tables = bundle(employees=[{}, {}])
    lacking = Cleaning(tables).tables.__class__(**{**vars(tables), "data_sources": None})
    with pytest.raises(ValueError, match="data_sources"):
        constraints.count_violations(lacking, constraints.domain_rules())
    narrow = tables.__class__(**{**vars(tables), "employees": tables.employees.drop("campus", "nationality")})
    required = keyed(constraints.count_violations(narrow, constraints.required_rules(narrow)), "table", "rule")
    assert required["employees", "campus not null"]["violations"] == 2
    lengths = {"employees": constraints.length_rules("employees", narrow.employees)}
    assert keyed(constraints.count_violations(narrow, lengths), "table", "rule")["employees", "nationality length <= 60"]["violations"] == 0


def test_keys_and_references(dirty, bundle):
    twice = bundle(training=[dict(training_id="T"), dict(training_id="T"), dict(training_id=None)])
    assert keyed(constraints.key_summary(twice), "table")["training"] == dict(key="training_id", bad_keys=2, rows=3)
    orphans = keyed(constraints.orphan_summary(dirty), "table", "key")
    assert orphans["employees", "manager_id"] == dict(orphan_keys=1, rows=2)
    assert orphans["recruitment", "hired_employee_id"] == dict(orphan_keys=1, rows=1)


def test_checks_and_required_values(bundle):
    tables = bundle(
        employees=[dict(gender=None), dict(gender="Other", salary=Decimal("0.00")), dict(campus="Moon", hire_date=None)],
        absences=[dict(days_absent=0, end_date=day("2023-02-06"))],
        recruitment=[dict(date_closed=None, time_to_fill_days=0), dict(date_closed=day("2022-03-01"))],
        training=[dict(cost_eur=Decimal("-1.00"), duration_hours=0)],
    )
    got = keyed(constraints.count_violations(tables, constraints.domain_rules(), constraints.range_rules()), "table", "rule")
    broken = {k for k, v in got.items() if v["violations"] == 1}
    assert broken == {
        ("employees", "gender domain"), ("employees", "salary > 0"), ("employees", "campus domain"),
        ("absences", "days_absent > 0"), ("absences", "end_date > start_date"),
        ("recruitment", "time_to_fill_days > 0"), ("recruitment", "date_closed > date_opened"),
        ("training", "duration_hours > 0"), ("training", "cost_eur >= 0"),
    }
    required = keyed(constraints.count_violations(tables, constraints.required_rules(tables)), "table", "rule")
    assert required["employees", "hire_date not null"]["violations"] == 1
    assert len(constraints.length_rules("employees")) == 13
    sources = quality.violations(
        benchmarks.data_sources(tables.employees.sparkSession), "data_sources", constraints.domain_rules()["data_sources"]
    )
    assert rows(sources) == [("data_sources", "source_type domain", 0)]


def test_business_rules(bundle):
    tables = bundle(
        employees=[dict(employee_id="UOG0001"), dict(employee_id="X", department="Finance", is_academic=True)],
        absences=[dict(absence_id="ABS00001"), dict(absence_type="Annual Leave"), dict(days_absent=2)],
        recruitment=[dict(job_req_id="JR0001"), dict(outcome="Ongoing")],
        leavers=[
            dict(employee_id="UOG0001", reason_for_leaving="Dismissal", years_of_service=Decimal("3.5")),
            dict(employee_id="X", rehire_eligible=False, years_of_service=Decimal("9.9")),
        ],
        training=[dict(training_id="TR00001"), dict(course_name="Excel"), dict(mandatory=False)],
    )
    got = {
        k: v["violations"]
        for k, v in keyed(constraints.count_violations(tables, constraints.business_rules()), "table", "rule").items()
    }
    assert got == {
        ("employees", "employee_id format"): 1,
        ("employees", "is_academic by department"): 1,
        ("absences", "absence_id format"): 2,
        ("absences", "interview only for sick leave of 3 days or more"): 2,
        ("recruitment", "job_req_id format"): 1,
        ("recruitment", "time_to_fill only when filled"): 1,
        ("recruitment", "no close date while ongoing"): 1,
        ("leavers", "rehire_eligible unless dismissed"): 2,
        ("training", "training_id format"): 2,
        ("training", "mandatory by course"): 2,
    }
    assert constraints.tenure_mismatches(tables).first().violations == 1


def test_defaults_and_set_null(bundle, dirty):
    frame = constraints.with_defaults(dirty.training.drop("dq_flag").withColumn("passed", F.lit(None).cast("boolean")), "training")
    assert {r[:2] for r in rows(frame, "passed", "dq_flag")} == {(True, "")}
    left = constraints.set_null_where_unknown(dirty.employees, "manager_id", dirty.employees, "employee_id")
    assert left.columns == dirty.employees.columns
    assert dict(rows(left, "employee_id", "manager_id")) == {"1": None, "2": "1", "3": None, "4": None}
