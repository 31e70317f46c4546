"""Time to fill and recruitment sources."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.functions.numbers import HALF_EVEN, mean, mean_of, percent, rounded
from rollcall.operators.quantiles import box_summary, distribution
from rollcall.operators.rollup import ROWS
from rollcall.sources.schemas import CANCELLED, FILLED, ONGOING, WITHDRAWN


def outcome_count(outcome):
    return F.count_if(F.col("outcome") == outcome)


def filled(recruitment: DataFrame) -> DataFrame:
    return recruitment.filter((F.col("outcome") == FILLED) & F.col("time_to_fill_days").isNotNull())


def time_to_fill(recruitment: DataFrame) -> DataFrame:
    """Roles filled, mean, shortest, longest and median days by department and role type."""
    spread = distribution(filled(recruitment), ["department", "is_academic"], "time_to_fill_days")
    return spread.select(
        "department",
        "is_academic",
        F.col("n").alias("roles_filled"),
        rounded(mean_of(F.col("total"), F.col("n")), 0).alias("avg_days_to_fill"),
        F.col("min").alias("min_days"),
        F.col("max").alias("max_days"),
        HALF_EVEN(F.col("median"), 0).cast("int").alias("median_days"),
    ).orderBy(F.desc_nulls_first("avg_days_to_fill"), "department", "is_academic")


def mean_time_to_fill(recruitment: DataFrame) -> DataFrame:
    """Mean days to fill by department."""
    days = rounded(mean(F.col("time_to_fill_days")), 1)
    return filled(recruitment).groupBy("department").agg(days.alias("avg_days_to_fill")).orderBy("department")


def source_effectiveness(recruitment: DataFrame) -> DataFrame:
    """Openings by outcome, fill rate and mean days to fill per source."""
    openings = F.count(ROWS)
    days = F.when(F.col("outcome") == FILLED, F.col("time_to_fill_days"))
    return (
        recruitment.groupBy("source")
        .agg(
            openings.alias("total_openings"),
            outcome_count(FILLED).alias("filled"),
            outcome_count(CANCELLED).alias("cancelled"),
            outcome_count(WITHDRAWN).alias("withdrawn"),
            outcome_count(ONGOING).alias("ongoing"),
            percent(outcome_count(FILLED), openings, 1).alias("fill_rate_pct"),
            rounded(mean(days), 0).alias("avg_ttf_when_filled"),
        )
        .orderBy(F.desc_nulls_first("fill_rate_pct"), "source")
    )


def source_sheet(recruitment: DataFrame) -> DataFrame:
    """Openings, filled and fill rate per known source."""
    rate = percent(outcome_count(FILLED), F.count(ROWS), 1, HALF_EVEN)
    return (
        recruitment.dropna(subset=["source"])
        .groupBy("source")
        .agg(F.count(ROWS).alias("total"), outcome_count(FILLED).alias("filled"), rate.alias("fill_rate_pct"))
        .orderBy("source")
    )


def source_totals(recruitment: DataFrame) -> DataFrame:
    """Openings and filled roles per source, fewest openings first."""
    counted = recruitment.dropna(subset=["source"]).groupBy("source")
    return counted.agg(F.count(ROWS).alias("total"), outcome_count(FILLED).alias("filled")).orderBy("total", "source")


def funnel(recruitment: DataFrame) -> DataFrame:
    """Stages per source. The tables hold no applications, so that stage is NULL."""
    stages = F.array(
        F.struct(F.lit("Openings").alias("stage"), F.col("total").alias("roles")),
        F.struct(F.lit("Applications").alias("stage"), F.lit(None).cast("bigint").alias("roles")),
        F.struct(F.lit("Filled").alias("stage"), F.col("filled").alias("roles")),
    )
    counted = recruitment.groupBy("source").agg(F.count(ROWS).alias("total"), outcome_count(FILLED).alias("filled"))
    return counted.select("source", F.inline(stages))


def time_to_fill_spread(recruitment: DataFrame) -> DataFrame:
    """Days to fill for academic and support roles as a box summary, with the mean."""
    box = box_summary(filled(recruitment).filter("is_academic is not null"), ["is_academic"], "time_to_fill_days")
    numbers = ["min", "q1", "median", "q3", "max", "whisker_low", "whisker_high"]
    return box.select(
        "is_academic",
        *[F.col(c).cast("double").alias(c) for c in numbers],
        rounded(mean_of(F.col("total"), F.col("n")), 2).alias("mean"),
    ).orderBy("is_academic")


def outcomes_by_department(recruitment: DataFrame) -> DataFrame:
    """Openings and mean days to fill by department and outcome."""
    days = rounded(mean(F.col("time_to_fill_days")), 0, HALF_EVEN)
    return (
        recruitment.dropna(subset=["department", "outcome"])
        .groupBy("department", "outcome")
        .agg(F.count("job_req_id").alias("count"), days.alias("avg_time_to_fill"))
        .orderBy("department", "outcome")
    )
