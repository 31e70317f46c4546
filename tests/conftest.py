import datetime as dt
import os
import sys
from decimal import Decimal

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from rollcall.session import local_session  # noqa: E402
from rollcall.sources import benchmarks, schemas  # noqa: E402
from rollcall.sources.tables import Workforce  # noqa: E402

FILES = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", 8, "4g")
    yield session
    session.stop()


def day(text):
    return dt.date.fromisoformat(text)


DEFAULTS = {
    "employees": dict(
        first_name="A", last_name="B", gender="Female", date_of_birth=day("1980-01-01"), nationality="Irish",
        hire_date=day("2020-01-15"), department="Research", job_title="Lecturer", employment_type="Permanent",
        grade="Professor", salary=Decimal("50000.00"), manager_id=None, campus="Remote", status="Active",
        is_academic=True, benchmark_salary_band=None, dq_flag="",
    ),
    "absences": dict(
        employee_id="E1", absence_type="Certified Sick Leave", start_date=day("2023-02-06"), end_date=day("2023-02-09"),
        days_absent=3, approved=True, return_to_work_interview=True, sector_avg_absence_rate_pct=None, dq_flag="",
    ),
    "recruitment": dict(
        job_title="Lecturer", department="Research", is_academic=True, date_opened=day("2022-03-01"),
        date_closed=day("2022-04-01"), time_to_fill_days=31, source="LinkedIn", outcome="Filled",
        hired_employee_id=None, salary_band_min=None, salary_band_max=None, dq_flag="",
    ),
    "leavers": dict(
        leaving_date=day("2023-06-30"), reason_for_leaving="Resignation", years_of_service=Decimal("3.0"),
        exit_interview_completed=True, rehire_eligible=True, destination="Retired", dq_flag="",
    ),
    "training": dict(
        employee_id="E1", course_name="Fire Safety", category="Health & Safety", provider="Internal",
        completion_date=day("2024-05-01"), duration_hours=2, passed=True, cost_eur=Decimal("0.00"), mandatory=True,
        dq_flag="",
    ),
    "staff_profile": dict(
        institution="X", year=2023, staff_category="Academic", grade="Professor", gender="Female", headcount=10,
        contract_type="Permanent", fte=Decimal("8.0"),
    ),
}
KEYS = {"employees": "employee_id", "absences": "absence_id", "recruitment": "job_req_id", "leavers": "employee_id",
        "training": "training_id"}


def make(spark, name, rows):
    """A table from partial rows: unnamed columns take a default, and a missing key counts up."""
    schema = schemas.SCHEMAS[name]
    key = KEYS.get(name)
    full = []
    for i, row in enumerate(rows, 1):
        base = dict(DEFAULTS[name])
        if key:
            base[key] = f"{name[0].upper()}{i}"
        base.update(row)
        full.append(tuple(base[f.name] for f in schema.fields))
    nullable = schemas.StructType([schemas.StructField(f.name, f.dataType, True) for f in schema.fields])
    return spark.createDataFrame(full, nullable)


@pytest.fixture()
def table(spark):
    return lambda name, *rows: make(spark, name, rows)


@pytest.fixture()
def bundle(spark):
    def build(**tables):
        names = ["employees", "absences", "recruitment", "leavers", "training", "staff_profile"]
        fixed = {n: getattr(benchmarks, n)(spark) for n in ("earnings", "pay_gap", "data_sources")}
        return Workforce(**{n: make(spark, n, tables.get(n, [])) for n in names}, **fixed)

    return build


def rows(df, *columns):
    """The rows as a list of tuples, of the named columns or all."""
    return [tuple(r) for r in (df.select(*columns) if columns else df).collect()]


def keyed(df, *keys):
    """Rows as dicts by key columns."""
    found = {}
    for r in df.collect():
        d = r.asDict()
        key = tuple(d.pop(k) for k in keys)
        found[key[0] if len(keys) == 1 else key] = d
    return found
