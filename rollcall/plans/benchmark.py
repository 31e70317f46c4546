"""Comparing the workforce with published headcounts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.functions.bands import lookup, variance_class
from rollcall.functions.numbers import HALF_EVEN, percent
from rollcall.operators.rollup import ROWS, stitch
from rollcall.plans.headcount import active
from rollcall.sources.schemas import ACADEMIC_GRADES, FEMALE, FEMALE_SHARE_BENCHMARK, GRADE_ORDER, MALE

CELL = ["grade", "gender"]
SUMMARY_NOTE = "Synthetic calibrated to HEA 2023 published figures"


def published(staff_profile: DataFrame, crosswalk: dict[str, str] | None = None) -> DataFrame:
    """Published heads per grade and gender, summed over contracts.

    A crosswalk renames published grades to the employees' labels; without it, differing labels never match.
    """
    grade = F.coalesce(lookup(F.col("grade"), crosswalk), F.col("grade")) if crosswalk else F.col("grade")
    return (
        staff_profile.withColumn("grade", grade)
        .groupBy(*CELL)
        .agg(F.sum("headcount").alias("published"), F.max("year").alias("year"))
    )


def observed(employees: DataFrame) -> DataFrame:
    return employees.groupBy(*CELL).agg(F.count("employee_id").alias("observed"))


def benchmark_comparison(employees: DataFrame, staff_profile: DataFrame, crosswalk=None) -> DataFrame:
    """K3: active heads against every published grade and gender."""
    joined = published(staff_profile, crosswalk).join(observed(active(employees)), CELL, "left")
    ours = F.coalesce("observed", F.lit(0))
    theirs = F.col("published")
    return joined.select(
        *CELL,
        theirs.alias("hea_real_headcount"),
        ours.alias("synthetic_headcount"),
        (ours - theirs).alias("variance_absolute"),
        percent(ours - theirs, theirs, 1).alias("variance_pct"),
        F.col("year").alias("hea_reference_year"),
    ).orderBy(*CELL)


def workforce_summary(employees: DataFrame, staff_profile: DataFrame, crosswalk=None) -> DataFrame:
    """B1: heads of all statuses against published heads, cells of either side."""
    cells = _cells(observed(employees), published(staff_profile, crosswalk))
    ours, theirs = F.col("observed"), F.col("published")
    return cells.select(
        *CELL,
        ours.cast("int").alias("synthetic_headcount"),
        theirs.cast("int").alias("real_hea_headcount"),
        (ours - theirs).cast("int").alias("variance_vs_real"),
        percent(ours - theirs, theirs, 1, HALF_EVEN).alias("variance_pct"),
        F.lit(SUMMARY_NOTE).alias("data_note"),
    ).orderBy(*CELL)


def variance_listing(summary: DataFrame) -> DataFrame:
    """The summary with the colour each variance is shown in."""
    return summary.withColumn("variance_class", variance_class(F.col("variance_vs_real")))


def academic_headcounts(
    employees: DataFrame, staff_profile: DataFrame, grades=ACADEMIC_GRADES, wrap: str = " / Postdoc"
) -> DataFrame:
    """C14: active and published heads of the academic grades, with a two-line label."""
    cells = _cells(observed(active(employees)), published(staff_profile)).filter(F.col("grade").isin(*grades))
    name = F.replace(F.col("grade"), F.lit(wrap), F.lit(wrap.replace(" / ", "\n/")))
    return cells.select(
        *CELL,
        F.col("observed").alias("synthetic"),
        F.col("published").alias("real_hea"),
        F.concat(name, F.lit("\n("), F.col("gender"), F.lit(")")).alias("label"),
    ).orderBy(*CELL)


def female_share_by_grade(
    employees: DataFrame, grades=GRADE_ORDER, shares: dict[str, int] = FEMALE_SHARE_BENCHMARK
) -> DataFrame:
    """Women among active women and men per grade, in fixed grade order, with the published share."""
    wide = (
        active(employees)
        .filter(F.col("grade").isin(*grades))
        .groupBy("grade")
        .pivot("gender", [FEMALE, MALE])
        .agg(F.count("employee_id"))
        .fillna(0, subset=[FEMALE, MALE])
    )
    women, men = F.col(FEMALE), F.col(MALE)
    position = F.array_position(F.array(*[F.lit(g) for g in grades]), F.col("grade"))
    return wide.orderBy(position).select(
        "grade",
        women,
        men,
        (women + men).alias("total"),
        percent(women, women + men).alias("pct_female"),
        lookup(F.col("grade"), {k: float(v) for k, v in shares.items()}).alias("benchmark"),
    )


def calibration(
    employees: DataFrame, staff_profile: DataFrame, share_points: float = 5, headcount_pct: float = 20, crosswalk=None
) -> DataFrame:
    """Is the active workforce close to the published one?

    Share of women per grade and share of permanent staff within 5 points; heads per grade and gender within 20%.
    """
    cells = _cells(observed(active(employees)), published(staff_profile, crosswalk))

    def of(gender, column):
        return F.sum(F.when(F.col("gender") == gender, F.col(column)).otherwise(0))

    by_grade = cells.groupBy("grade").agg(
        percent(of(FEMALE, "observed"), of(FEMALE, "observed") + of(MALE, "observed"), 2).alias("observed"),
        percent(of(FEMALE, "published"), of(FEMALE, "published") + of(MALE, "published"), 2).alias("expected"),
    )
    women = by_grade.filter("observed is not null and expected is not null").select(
        F.lit("female_share_pct").alias("measure"),
        F.col("grade").alias("subject"),
        "observed",
        "expected",
        F.lit(share_points).cast("double").alias("tolerance"),
    )
    heads = cells.filter("published > 0").select(
        F.lit("headcount_pct_of_published").alias("measure"),
        F.concat("grade", F.lit(" / "), "gender").alias("subject"),
        percent(F.col("observed"), F.col("published"), 2).alias("observed"),
        F.lit(100.0).alias("expected"),
        F.lit(headcount_pct).cast("double").alias("tolerance"),
    )
    ours = active(employees).agg(F.count_if(F.col("employment_type") == "Permanent").alias("a"), F.count(ROWS).alias("b"))
    permanent_heads = F.sum(F.when(F.col("contract_type") == "Permanent", F.col("headcount")))
    theirs = staff_profile.agg(permanent_heads.alias("c"), F.sum("headcount").alias("d"))
    permanent = stitch([], ours, theirs).select(
        F.lit("permanent_share_pct").alias("measure"),
        F.lit("all").alias("subject"),
        percent(F.col("a"), F.col("b"), 2).alias("observed"),
        percent(F.col("c"), F.col("d"), 2).alias("expected"),
        F.lit(share_points).cast("double").alias("tolerance"),
    )
    diff = (F.col("observed").cast("decimal(12,2)") - F.col("expected").cast("decimal(12,2)")).cast("double")
    return (
        women.unionByName(heads)
        .unionByName(permanent)
        .withColumn("diff", diff)
        .withColumn("ok", F.abs("diff") <= F.col("tolerance"))
    )


def _cells(ours, theirs):
    return stitch(CELL, ours, theirs.drop("year")).dropna(subset=CELL).fillna(0, subset=["observed", "published"])
