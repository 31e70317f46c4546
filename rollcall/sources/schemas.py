"""Declared table schemas and value domains. Tables are always read with these, never inferred."""

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DateType,
    DecimalType,
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

TEXT, DATE, FLAG, WHOLE = StringType(), DateType(), BooleanType(), IntegerType()


def _table(*fields):
    return StructType([StructField(name, kind, nullable) for name, kind, nullable in fields])


def _required(name, kind=TEXT):
    return (name, kind, False)


def _optional(name, kind=TEXT):
    return (name, kind, True)


EMPLOYEES = _table(
    _required("employee_id"),
    _required("first_name"),
    _required("last_name"),
    _optional("gender"),
    _optional("date_of_birth", DATE),
    _optional("nationality"),
    _required("hire_date", DATE),
    _required("department"),
    _required("job_title"),
    _required("employment_type"),
    _required("grade"),
    _required("salary", DecimalType(10, 2)),
    _optional("manager_id"),
    _required("campus"),
    _required("status"),
    _required("is_academic", FLAG),
    _optional("benchmark_salary_band"),
    _optional("dq_flag"),
)

ABSENCES = _table(
    _required("absence_id"),
    _required("employee_id"),
    _required("absence_type"),
    _required("start_date", DATE),
    _required("end_date", DATE),
    _required("days_absent", WHOLE),
    _required("approved", FLAG),
    _optional("return_to_work_interview", FLAG),
    _optional("sector_avg_absence_rate_pct", DecimalType(4, 1)),
    _optional("dq_flag"),
)

RECRUITMENT = _table(
    _required("job_req_id"),
    _required("job_title"),
    _required("department"),
    _required("is_academic", FLAG),
    _required("date_opened", DATE),
    _optional("date_closed", DATE),
    _optional("time_to_fill_days", WHOLE),
    _optional("source"),
    _required("outcome"),
    _optional("hired_employee_id"),
    _optional("salary_band_min", DecimalType(10, 2)),
    _optional("salary_band_max", DecimalType(10, 2)),
    _optional("dq_flag"),
)

LEAVERS = _table(
    _required("employee_id"),
    _required("leaving_date", DATE),
    _required("reason_for_leaving"),
    _optional("years_of_service", DecimalType(5, 1)),
    _required("exit_interview_completed", FLAG),
    _required("rehire_eligible", FLAG),
    _optional("destination"),
    _optional("dq_flag"),
)

TRAINING = _table(
    _required("training_id"),
    _required("employee_id"),
    _required("course_name"),
    _required("category"),
    _required("provider"),
    _required("completion_date", DATE),
    _required("duration_hours", WHOLE),
    _required("passed", FLAG),
    _required("cost_eur", DecimalType(8, 2)),
    _required("mandatory", FLAG),
    _optional("dq_flag"),
)

STAFF_PROFILE = _table(
    _required("institution"),
    _required("year", WHOLE),
    _required("staff_category"),
    _required("grade"),
    _required("gender"),
    _required("headcount", WHOLE),
    _optional("contract_type"),
    _optional("fte", DecimalType(8, 1)),
)

EARNINGS = _table(
    _required("year", WHOLE),
    _required("quarter"),
    _required("sector"),
    _optional("avg_hourly_earnings_eur", DecimalType(8, 2)),
    _optional("avg_weekly_earnings_eur", DecimalType(10, 2)),
    _optional("avg_total_labour_cost_eur", DecimalType(8, 2)),
    _optional("source_url"),
)

PAY_GAP = _table(
    _required("sector"),
    _required("metric"),
    _optional("value_pct", DecimalType(5, 1)),
    _optional("direction"),
    _optional("source_note"),
)

DATA_SOURCES = _table(
    _required("source_name"),
    _required("source_type"),
    _optional("publication_year", WHOLE),
    _optional("url"),
    _optional("description"),
    _optional("tables_populated", ArrayType(TEXT)),
    _optional("created_at", TimestampType()),
)

WORKFORCE_SUMMARY = _table(
    _required("grade"),
    _required("gender"),
    _required("synthetic_headcount", WHOLE),
    _required("real_hea_headcount", WHOLE),
    _required("variance_vs_real", WHOLE),
    _optional("variance_pct", DoubleType()),
    _optional("data_note"),
)

SCHEMAS = {
    "employees": EMPLOYEES,
    "absences": ABSENCES,
    "recruitment": RECRUITMENT,
    "leavers": LEAVERS,
    "training": TRAINING,
    "staff_profile": STAFF_PROFILE,
    "earnings": EARNINGS,
    "pay_gap": PAY_GAP,
    "data_sources": DATA_SOURCES,
    "workforce_summary": WORKFORCE_SUMMARY,
}

# The lengths declared for the text columns that have one.
TEXT_LENGTHS = {
    "employees": {
        "employee_id": 10, "first_name": 60, "last_name": 60, "gender": 10, "nationality": 60,
        "department": 80, "job_title": 100, "employment_type": 20, "grade": 80, "manager_id": 10,
        "campus": 40, "status": 20, "benchmark_salary_band": 30,
    },
    "absences": {"absence_id": 10, "employee_id": 10, "absence_type": 40},
    "recruitment": {
        "job_req_id": 10, "job_title": 100, "department": 80, "source": 60, "outcome": 20, "hired_employee_id": 10,
    },
    "leavers": {"employee_id": 10, "reason_for_leaving": 60, "destination": 60},
    "training": {"training_id": 10, "employee_id": 10, "course_name": 120, "category": 60, "provider": 60},
}

# The words the tables use.
ACTIVE = "Active"
FEMALE, MALE = "Female", "Male"
SICK_TYPES = ("Certified Sick Leave", "Uncertified Sick Leave")
FILLED, ONGOING, CANCELLED, WITHDRAWN = "Filled", "Ongoing", "Cancelled", "Withdrawn"

SOURCE_TYPES = ("Real", "Synthetic")
GENDERS = ("Female", "Male", "Non-Binary", "Unknown")
BENCHMARK_GENDERS = ("Female", "Male", "Unknown")
EMPLOYMENT_TYPES = ("Permanent", "Fixed-Term", "Part-Time")
CAMPUSES = ("Galway Main", "Galway Hospital", "Remote")
STATUSES = ("Active", "Resigned", "Retired", "End of Contract")
OUTCOMES = ("Filled", "Cancelled", "Ongoing", "Withdrawn")
DEPARTMENTS = (
    "Academic Affairs", "Research", "Finance", "IT", "HR",
    "Student Services", "Estates & Facilities", "Library", "Registry", "Executive Office",
)
ACADEMIC_DEPARTMENTS = ("Academic Affairs", "Research")
MANDATORY_COURSES = (
    "GDPR Awareness", "Manual Handling", "Fire Safety", "Display Screen Equipment", "Dignity at Work",
)
GRADE_ORDER = (
    "Grade 3-4", "Grade 5", "Grade 6", "Grade 7", "Senior Management",
    "Research Fellow / Postdoc", "Lecturer Below Bar",
    "Senior Lecturer Above Bar", "Associate Professor", "Professor",
)
ACADEMIC_GRADES = (
    "Professor", "Associate Professor", "Senior Lecturer Above Bar", "Lecturer Below Bar", "Research Fellow / Postdoc",
)
SALARY_BANDS = {
    "Grade 3-4": "€28,000–€38,000",
    "Grade 5": "€35,000–€50,000",
    "Grade 6": "€45,000–€62,000",
    "Grade 7": "€56,000–€75,000",
    "Senior Management": "€72,000–€110,000",
    "Lecturer Below Bar": "€52,000–€75,000",
    "Senior Lecturer Above Bar": "€72,000–€95,000",
    "Associate Professor": "€88,000–€110,000",
    "Professor": "€102,000–€130,000",
    "Research Fellow / Postdoc": "€40,000–€68,000",
}
FEMALE_SHARE_BENCHMARK = {
    "Professor": 28,
    "Associate Professor": 35,
    "Senior Lecturer Above Bar": 42,
    "Lecturer Below Bar": 52,
    "Research Fellow / Postdoc": 48,
}
ID_PATTERNS = {
    "employee_id": r"^UOG\d{4}$",
    "absence_id": r"^ABS\d{5}$",
    "job_req_id": r"^JR\d{4}$",
    "training_id": r"^TR\d{5}$",
}
