"""Calendar helpers. Every date that depends on 'today' is a parameter."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MONTH_NAMES = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]


def month_of(c: Column) -> Column:
    return F.trunc(c, "MM")


def months_before(day: dt.date, months: int) -> Column:
    return F.add_months(F.lit(day), -months)


def completed_years(start: Column, as_of: dt.date) -> Column:
    """Whole years between two dates, as an age is counted."""
    return F.timestamp_diff("YEAR", start, F.lit(as_of)).cast("int")


def years_between(start: Column, end: Column) -> Column:
    return F.datediff(end, start) / F.lit(365.25)


def month_spine(spark: SparkSession, first: dt.date, last: dt.date) -> DataFrame:
    """One row per month, both ends included."""
    months = F.sequence(F.lit(first), F.lit(last), F.make_ym_interval(F.lit(0), F.lit(1)))
    return spark.range(1, numPartitions=1).select(F.explode(months).alias("month_start"))
