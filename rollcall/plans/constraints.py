"""The declared constraints and documented business rules as counted rules."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.functions.numbers import HALF_EVEN
from rollcall.operators.quality import Rule, duplicate_keys, mark_orphans, not_in, union, unless, violations
from rollcall.operators.rollup import ROWS
from rollcall.sources import schemas

PRIMARY_KEYS = {
    "employees": "employee_id",
    "absences": "absence_id",
    "recruitment": "job_req_id",
    "leavers": "employee_id",
    "training": "training_id",
}
FOREIGN_KEYS = [
    ("employees", "manager_id"),
    ("absences", "employee_id"),
    ("recruitment", "hired_employee_id"),
    ("leavers", "employee_id"),
    ("training", "employee_id"),
]
REQUIRED_TABLES = (
    "employees", "absences", "recruitment", "leavers", "training", "staff_profile", "earnings", "pay_gap", "data_sources",
)
DEFAULTS = {
    "employees": {"is_academic": False, "dq_flag": ""},
    "absences": {"approved": True, "dq_flag": ""},
    "recruitment": {"is_academic": False, "dq_flag": ""},
    "leavers": {"exit_interview_completed": False, "rehire_eligible": True, "dq_flag": ""},
    "training": {"passed": True, "cost_eur": 0, "mandatory": False, "dq_flag": ""},
}


def key_summary(tables) -> DataFrame:
    """Per table, keys that repeat or are NULL, and the rows they hold."""
    parts = []
    for name, key in PRIMARY_KEYS.items():
        bad = duplicate_keys(getattr(tables, name), key)
        counted = bad.agg(F.count(ROWS).alias("bad_keys"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"))
        parts.append(counted.select(F.lit(name).alias("table"), F.lit(key).alias("key"), "bad_keys", "rows"))
    return union(parts)


def orphan_summary(tables) -> DataFrame:
    """Per foreign key, unknown keys and the rows that hold them. Rows are counted per key first."""
    parts = []
    for name, key in FOREIGN_KEYS:
        child = getattr(tables, name)
        per_key = child.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(ROWS).alias("rows"))
        known = tables.employees.select(F.col("employee_id").alias(key))
        counted = per_key.join(known, key, "left_anti").agg(
            F.count(ROWS).alias("orphan_keys"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows")
        )
        parts.append(counted.select(F.lit(name).alias("table"), F.lit(key).alias("key"), "orphan_keys", "rows"))
    return union(parts)


def domain_rules(campuses=schemas.CAMPUSES) -> dict[str, list[Rule]]:
    """D20."""

    def rule(column, domain):
        return Rule(f"{column} domain", not_in(column, domain))

    return {
        "data_sources": [rule("source_type", schemas.SOURCE_TYPES)],
        "staff_profile": [rule("gender", schemas.BENCHMARK_GENDERS)],
        "employees": [
            rule("gender", schemas.GENDERS),
            rule("employment_type", schemas.EMPLOYMENT_TYPES),
            rule("campus", campuses),
            rule("status", schemas.STATUSES),
        ],
        "recruitment": [rule("outcome", schemas.OUTCOMES)],
    }


def range_rules() -> dict[str, list[Rule]]:
    """D21, D22."""
    c = F.col
    return {
        "staff_profile": [Rule("headcount >= 0", unless(c("headcount") >= 0))],
        "employees": [Rule("salary > 0", unless(c("salary") > 0))],
        "absences": [
            Rule("days_absent > 0", unless(c("days_absent") > 0)),
            Rule("end_date > start_date", unless(c("end_date") > c("start_date"))),
        ],
        "recruitment": [
            Rule("time_to_fill_days > 0", unless(c("time_to_fill_days") > 0)),
            Rule("date_closed > date_opened", unless(c("date_closed").isNull() | (c("date_closed") > c("date_opened")))),
        ],
        "training": [
            Rule("duration_hours > 0", unless(c("duration_hours") > 0)),
            Rule("cost_eur >= 0", unless(c("cost_eur") >= 0)),
        ],
    }


def required_rules(tables=None) -> dict[str, list[Rule]]:
    """NULL where a value is required. A required column that a frame lacks is broken by every row."""
    wanted = {}
    for name in REQUIRED_TABLES:
        present = None if tables is None else set(getattr(tables, name).columns)
        wanted[name] = [
            Rule(f"{c} not null", F.col(c).isNull() if present is None or c in present else F.lit(True))
            for c in (field.name for field in schemas.SCHEMAS[name].fields if not field.nullable)
        ]
    return wanted


def length_rules(name: str, df: DataFrame | None = None) -> list[Rule]:
    """Text longer than its declared column. A column that the frame lacks holds no text."""
    present = None if df is None else set(df.columns)
    return [
        Rule(f"{c} length <= {n}", unless(F.length(c) <= n) if present is None or c in present else F.lit(False))
        for c, n in schemas.TEXT_LENGTHS[name].items()
    ]


def business_rules(id_patterns: dict[str, str] = schemas.ID_PATTERNS, mandatory_courses=schemas.MANDATORY_COURSES,
                   academic_departments=schemas.ACADEMIC_DEPARTMENTS) -> dict[str, list[Rule]]:
    """Documented rules that hold between the columns of one row."""
    c = F.col
    sick = c("absence_type").isin(*schemas.SICK_TYPES)

    def pattern(column):
        return Rule(f"{column} format", unless(c(column).rlike(id_patterns[column])))

    return {
        "employees": [
            pattern("employee_id"),
            Rule("is_academic by department", c("is_academic") != c("department").isin(*academic_departments)),
        ],
        "absences": [
            pattern("absence_id"),
            Rule(
                "interview only for sick leave of 3 days or more",
                c("return_to_work_interview").isNotNull() & ~(sick & (c("days_absent") >= 3)),
            ),
        ],
        "recruitment": [
            pattern("job_req_id"),
            Rule("time_to_fill only when filled", c("time_to_fill_days").isNotNull() & (c("outcome") != schemas.FILLED)),
            Rule("no close date while ongoing", c("date_closed").isNotNull() & (c("outcome") == schemas.ONGOING)),
        ],
        "leavers": [
            Rule(
                "rehire_eligible unless dismissed",
                c("rehire_eligible") == (c("reason_for_leaving") == "Dismissal"),
            ),
        ],
        "training": [
            pattern("training_id"),
            Rule("mandatory by course", c("mandatory") != c("course_name").isin(*mandatory_courses)),
        ],
    }


def tenure_mismatches(tables) -> DataFrame:
    """Leavers whose years of service are not the days between hire and leaving over 365.25, to one decimal."""
    hired = tables.employees.select("employee_id", "hire_date")
    days = F.datediff("leaving_date", "hire_date").cast("decimal(12,2)")
    years = HALF_EVEN(days / F.lit(365.25).cast("decimal(6,2)"), 1)
    joined = tables.leavers.join(hired, "employee_id")
    return joined.agg(F.count_if(F.col("years_of_service") != years).alias("violations")).select(
        F.lit("leavers").alias("table"), F.lit("tenure from dates").alias("rule"), "violations"
    )


def count_violations(tables, *rule_sets: dict[str, list[Rule]]) -> DataFrame:
    """Rows breaking each rule: one pass per table over all its rules. A table that the bundle lacks is an error."""
    merged: dict[str, list[Rule]] = {}
    for rules in rule_sets:
        for name, some in rules.items():
            if getattr(tables, name, None) is None:
                raise ValueError(f"no table {name} to check: {', '.join(r.name for r in some)}")
            merged.setdefault(name, []).extend(some)
    return union(violations(getattr(tables, name), name, rules) for name, rules in merged.items() if rules)


def with_defaults(df: DataFrame, table: str) -> DataFrame:
    """Declared defaults in place of NULL; a column the frame lacks is added."""
    for column, value in DEFAULTS[table].items():
        kind = schemas.SCHEMAS[table][column].dataType
        default = F.lit(value).cast(kind)
        df = df.withColumn(column, F.coalesce(F.col(column), default) if column in df.columns else default)
    return df


def set_null_where_unknown(child: DataFrame, key: str, parent: DataFrame, spread_by: str) -> DataFrame:
    """References to employees that are gone become NULL."""
    columns = child.columns
    marked = mark_orphans(child, key, parent, "employee_id", "unknown", spread_by)
    return marked.withColumn(key, F.when(~F.col("unknown"), F.col(key))).select(*columns)


