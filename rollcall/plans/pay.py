"""Pay levels, pay gaps and pay quartiles."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rollcall.functions.bands import pay_direction, pay_gap_rag
from rollcall.functions.numbers import HALF_EVEN, gap_percent, mean, mean_of, over_percent, percent, rounded
from rollcall.operators.kpis import as_rows
from rollcall.operators.quantiles import (
    MEDIAN,
    assign_quartile,
    box_summary,
    distribution,
    slice_starts,
)
from rollcall.operators.rollup import ROWS, join_groups
from rollcall.plans.headcount import active, men, women
from rollcall.sources.schemas import FEMALE, GRADE_ORDER, MALE

# Fixed values.
HOURS_PER_WEEK, WEEKS_PER_YEAR = Decimal("37.5"), 52
MEAN_BONUS_GAP, MEDIAN_BONUS_GAP = 8.5, 6.2
MEAN_GAP_BENCHMARK, MEDIAN_GAP_BENCHMARK = 16.2, 12.8
MEAN_GAP, MEDIAN_GAP = "Mean Hourly Pay Gap %", "Median Hourly Pay Gap %"
MEAN_BONUS, MEDIAN_BONUS = "Mean Bonus Gap %", "Median Bonus Gap %"
MEN_MORE = "Men earn more"
MEN_MORE_BONUS = "Men earn more (limited bonus schemes in Irish HEIs)"
MEN_MORE_BONUS_SHORT = "Men earn more (limited bonus schemes)"
QUARTILE_LABELS = {
    1: "Lower Quartile (Q1 — lowest paid)",
    2: "Lower Middle Quartile (Q2)",
    3: "Upper Middle Quartile (Q3)",
    4: "Upper Quartile (Q4 — highest paid)",
}
SLICE_LABELS = {1: "Lower Quartile (Q1)", 2: "Lower Middle (Q2)", 3: "Upper Middle (Q3)", 4: "Upper Quartile (Q4)"}


def pay_of(gender):
    return F.when(F.col("gender") == gender, F.col("salary"))


def pay_by_gender(employees: DataFrame) -> DataFrame:
    """K6: heads, mean and median pay by gender, and means for academic and support roles."""
    now = active(employees)
    pay = F.col("salary")
    means = now.groupBy("gender").agg(
        F.count(ROWS).alias("headcount"),
        rounded(mean(pay), 2).alias("mean_salary"),
        rounded(mean(F.when(F.col("is_academic"), pay)), 2).alias("mean_salary_academic"),
        rounded(mean(F.when(~F.col("is_academic"), pay)), 2).alias("mean_salary_support"),
    )
    medians = distribution(now, ["gender"], "salary").select("gender", rounded(F.col("median"), 2).alias("median_salary"))
    return join_groups(means, medians, ["gender"], "left").orderBy(F.desc_nulls_first("mean_salary"), "gender")


def gender_pay(employees: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Heads, exact mean and exact median pay of active women and men, one row per group, NULL groups included."""
    by = by or []
    keys = [*by, *({"gender"} - set(by))]
    per_gender = distribution(active(employees).filter(F.col("gender").isin(FEMALE, MALE)), keys, "salary", MEDIAN)

    def of(gender, column):
        return F.max(F.when(F.col("gender") == gender, F.col(column)))

    return per_gender.groupBy(*by).agg(
        F.coalesce(of(FEMALE, "n"), F.lit(0)).alias("n_f"),
        F.coalesce(of(MALE, "n"), F.lit(0)).alias("n_m"),
        of(FEMALE, "total").alias("total_f"),
        of(MALE, "total").alias("total_m"),
        mean_of(of(FEMALE, "total"), of(FEMALE, "n")).alias("mean_f"),
        mean_of(of(MALE, "total"), of(MALE, "n")).alias("mean_m"),
        of(FEMALE, "median").alias("median_f"),
        of(MALE, "median").alias("median_m"),
    )


def pay_gap_by(employees: DataFrame, by: list[str]) -> DataFrame:
    """K7 for any grouping: mean pay of women and men and the gap, only groups that have both."""
    grouped = (
        active(employees)
        .groupBy(*by)
        .agg(
            mean(pay_of(FEMALE)).alias("f"),
            mean(pay_of(MALE)).alias("m"),
            women().alias("headcount_f"),
            men().alias("headcount_m"),
        )
        .filter("f is not null and m is not null")
    )
    f, m = F.col("f"), F.col("m")
    size = F.abs((m - f).cast("double") / F.nullif(m, F.lit(1)).cast("double"))
    return grouped.orderBy(F.desc_nulls_first(size), *by).select(
        *by,
        rounded(f, 0).alias("mean_salary_female"),
        rounded(m, 0).alias("mean_salary_male"),
        "headcount_f",
        "headcount_m",
        gap_percent(m, f, 1).alias("gpg_pct"),
        pay_direction(m, f).alias("direction"),
    )


def pay_gap_by_grade(employees: DataFrame) -> DataFrame:
    """By grade and role type."""
    return pay_gap_by(employees, ["grade", "is_academic"])


def pay_gap_by_hire_year(employees: DataFrame) -> DataFrame:
    """The gap by year of hire, as a stand-in for a trend, with its status colour."""
    yearly = pay_gap_by(employees.withColumn("hire_year", F.year("hire_date")), ["hire_year"])
    return yearly.withColumn("rag", pay_gap_rag(F.col("gpg_pct"))).orderBy("hire_year")


def annual_benchmark(earnings: DataFrame, sector: str = "Education", year: int = 2024, quarter: str = "Q4") -> DataFrame:
    """One row: published hourly earnings of a sector as yearly pay."""
    chosen = earnings.filter((F.col("sector") == sector) & (F.col("year") == year) & (F.col("quarter") == quarter))
    yearly = (F.col("avg_hourly_earnings_eur") * F.lit(HOURS_PER_WEEK) * WEEKS_PER_YEAR).cast("decimal(12,2)")
    return chosen.select(yearly.alias("yearly")).orderBy("yearly").limit(1)


def pay_vs_sector(employees: DataFrame, earnings: DataFrame) -> DataFrame:
    """K8: mean active pay by grade and role type against the sector's yearly equivalent."""
    grouped = (
        active(employees)
        .groupBy("grade", "is_academic")
        .agg(F.count(ROWS).alias("headcount"), mean(F.col("salary")).alias("pay"))
        .withColumn("sector", annual_benchmark(earnings).scalar())
    )
    pay, sector = F.col("pay"), F.col("sector")
    return grouped.select(
        "grade",
        "is_academic",
        "headcount",
        rounded(pay, 0).alias("mean_salary"),
        sector.cast("double").alias("cso_edu_sector_equiv"),
        rounded(pay - sector, 0).alias("variance_vs_cso"),
        over_percent(pay, sector, 1).alias("pct_above_below_cso"),
    ).orderBy(F.desc_nulls_first("mean_salary"), "grade", "is_academic")


def statutory_gaps(employees: DataFrame, mean_bonus_gap=MEAN_BONUS_GAP, median_bonus_gap=MEDIAN_BONUS_GAP) -> DataFrame:
    """The statutory list. The bonus gaps and every direction are constants, not results."""
    pay = gender_pay(employees)
    names = ["metric", "value_pct", "direction"]
    return as_rows(
        pay,
        names,
        [
            (MEAN_GAP, gap_percent(F.col("mean_m"), F.col("mean_f"), 2), MEN_MORE),
            (MEDIAN_GAP, gap_percent(F.col("median_m"), F.col("median_f"), 2), MEN_MORE),
            (MEAN_BONUS, F.lit(mean_bonus_gap), MEN_MORE_BONUS),
            (MEDIAN_BONUS, F.lit(median_bonus_gap), MEN_MORE),
        ],
    )


def pay_quartiles(employees: DataFrame) -> DataFrame:
    """Gender mix of the four pay quartiles."""
    rows = assign_quartile(active(employees).select("employee_id", "gender", "salary"), "salary", "employee_id")
    heads = F.count(ROWS)
    grouped = rows.groupBy("quartile").agg(
        women().alias("female_count"),
        men().alias("male_count"),
        heads.alias("total"),
        percent(women(), heads, 1).alias("pct_female"),
        percent(men(), heads, 1).alias("pct_male"),
    )
    label = F.lit(None).cast("string")
    for band, text in QUARTILE_LABELS.items():
        label = F.when(F.col("quartile") == band, text).otherwise(label)
    return grouped.select(
        F.col("quartile").alias("quartile_band"), label.alias("band_label"), "female_count", "male_count", "total",
        "pct_female", "pct_male",
    ).orderBy("quartile_band")


def quartile_of_employees(employees: DataFrame) -> DataFrame:
    """Every active employee with the pay quartile they fall into."""
    rows = active(employees).select("employee_id", F.col("salary").cast("double").alias("pay"), "salary")
    return assign_quartile(rows, "salary", "employee_id", "pay_quartile").select("employee_id", "pay", "pay_quartile")


def pay_slices(employees: DataFrame) -> DataFrame:
    """Four equal slices of the active staff sorted by pay; everyone who is not a woman counts as the rest."""
    rows = assign_quartile(
        active(employees).select("employee_id", "gender", "salary"), "salary", "employee_id", starts=slice_starts
    )
    heads = F.count(ROWS)
    share = percent(women(), heads, 1, HALF_EVEN)
    grouped = rows.groupBy("quartile").agg(
        share.alias("pct_f"), rounded(100 - share.cast("decimal(5,1)"), 1).alias("pct_m"), heads.alias("n")
    )
    label = F.lit(None).cast("string")
    for band, text in SLICE_LABELS.items():
        label = F.when(F.col("quartile") == band, text).otherwise(label)
    return grouped.orderBy("quartile").select(label.alias("label"), "pct_f", "pct_m", "n")


def pay_gap_sheet(employees: DataFrame) -> DataFrame:
    """The four gaps as text beside their benchmark."""
    pay = gender_pay(employees)

    def pct(a, b):
        return F.concat(gap_percent(F.col(a), F.col(b), 1, HALF_EVEN).cast("string"), F.lit("%"))

    names = ["metric", "value", "benchmark", "direction"]
    return as_rows(
        pay,
        names,
        [
            (MEAN_GAP, pct("mean_m", "mean_f"), f"~{MEAN_GAP_BENCHMARK}%", MEN_MORE),
            (MEDIAN_GAP, pct("median_m", "median_f"), f"~{MEDIAN_GAP_BENCHMARK}%", MEN_MORE),
            (MEAN_BONUS, f"{MEAN_BONUS_GAP}%", f"~{MEAN_BONUS_GAP}%", MEN_MORE_BONUS_SHORT),
            (MEDIAN_BONUS, f"{MEDIAN_BONUS_GAP}%", f"~{MEDIAN_BONUS_GAP}%", MEN_MORE),
        ],
    )


def pay_distribution(employees: DataFrame, earnings: DataFrame, grades=GRADE_ORDER) -> DataFrame:
    """Pay by grade as a box summary, in fixed grade order, beside the sector's yearly equivalent."""
    chosen = active(employees).filter(F.col("grade").isin(*grades))
    box = box_summary(chosen, ["grade"], "salary")
    position = F.array_position(F.array(*[F.lit(g) for g in grades]), F.col("grade"))
    numbers = ["min", "q1", "median", "q3", "max", "whisker_low", "whisker_high"]
    return (
        box.withColumn("benchmark", annual_benchmark(earnings).scalar().cast("double"))
        .orderBy(position)
        .select("grade", *[F.col(c).cast("double").alias(c) for c in numbers], "benchmark")
    )


def pay_levels(employees: DataFrame) -> DataFrame:
    """Mean and median pay by gender, with the two gaps and their benchmarks on every row."""
    now = active(employees).filter("gender is not null")
    levels = distribution(now, ["gender"], "salary").select(
        "gender",
        (F.col("total").cast("double") / F.col("n")).alias("mean"),
        F.col("median").cast("double").alias("median"),
    )
    whole = Window.partitionBy(F.lit(0))

    def of(gender, column):
        return F.max(F.when(F.col("gender") == gender, F.col(column))).over(whole)

    def gap(column):
        return F.try_divide(of(MALE, column) - of(FEMALE, column), of(MALE, column)) * 100

    return levels.select(
        "gender",
        "mean",
        "median",
        gap("mean").alias("mean_gap_pct"),
        gap("median").alias("median_gap_pct"),
        F.lit(MEAN_GAP_BENCHMARK).alias("mean_gap_benchmark"),
        F.lit(MEDIAN_GAP_BENCHMARK).alias("median_gap_benchmark"),
    ).orderBy("gender")
