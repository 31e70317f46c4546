"""Published benchmark figures as small DataFrames. The rows are fixed values; sizes never grow with the data."""

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.sources import schemas

# Category, grade, headcount, share of women.
STAFF_PROFILE_GRADES = [
    ("Academic", "Professor", 200, "0.28"),
    ("Academic", "Associate Professor", 180, "0.35"),
    ("Academic", "Senior Lecturer Above Bar", 300, "0.42"),
    ("Academic", "Lecturer Below Bar", 420, "0.52"),
    ("Academic", "Research Fellow / Postdoc", 600, "0.48"),
    ("Professional & Support", "Director / Head of Function", 80, "0.45"),
    ("Professional & Support", "Executive Officer / Grade 7", 250, "0.58"),
    ("Professional & Support", "Senior Administrator / Grade 6", 400, "0.62"),
    ("Professional & Support", "Administrator / Grade 5", 600, "0.65"),
    ("Professional & Support", "Clerical / Grade 3-4", 370, "0.68"),
]
CONTRACT_SHARES = {"Permanent": "0.58", "Fixed-Term": "0.42"}
FTE_RATES = {"Academic": "0.82", "Professional & Support": "0.83"}

# Year, quarter, sector, hourly, weekly, total labour cost, release.
EARNINGS_ROWS = [
    (2023, "Q4", "Education", "48.59", "1152.00", "48.65", "https://www.cso.ie/en/releasesandpublications/ep/p-elc/earningsandlabourcostsq42023/"),
    (2024, "Q4", "Education", "49.80", "1185.00", "50.20", "https://www.cso.ie/en/releasesandpublications/ep/p-elc/earningsandlabourcostsq42024/"),
    (2025, "Q3", "Education", "51.23", "1219.00", "51.60", "https://www.cso.ie/en/releasesandpublications/ep/p-elc/earningsandlabourcostsq32025/"),
    (2024, "Q4", "All Sectors", "30.21", "718.00", "31.50", "https://www.cso.ie/en/releasesandpublications/ep/p-elc/earningsandlabourcostsq42024/"),
    (2025, "Q3", "Public Sector (all)", "43.18", "1244.47", "44.10", "https://www.cso.ie/en/releasesandpublications/ep/p-elc/earningsandlabourcostsq32025/"),
]

# Sector, metric, value, direction, note.
PAY_GAP_ROWS = [
    ("Irish HEI Sector", "Mean Gender Pay Gap %", "16.2", "Men paid more",
     "HEA Gender Equality reports 2022/2023; avg across 7 Irish universities"),
    ("Irish HEI Sector", "Median Gender Pay Gap %", "12.8", "Men paid more",
     "Same source — median lower due to compression at clerical grades"),
    ("Irish HEI Sector", "Mean Bonus Gap %", "8.5", "Men paid more",
     "Performance-related pay gap; limited bonus schemes in Irish HEIs"),
    ("Irish HEI Sector", "Professor grade % female", "28.0", "Grade concentration driver",
     "HEA Staff Profiles 2023 — pipeline gap at senior academic grades"),
    ("Irish Public Sector", "Mean Gender Pay Gap %", "11.4", "Men paid more",
     "CSO ELC Gender Pay Gap estimates 2023"),
    ("Irish Private Sector", "Mean Gender Pay Gap %", "14.7", "Men paid more",
     "CSO ELC Gender Pay Gap estimates 2023"),
]

# Name, type, year, url, description, tables it fills.
DATA_SOURCE_ROWS = [
    ("HEA Staff Profiles by Gender 2023", "Real", 2023,
     "https://hea.ie/policy/gender/statistics/higher-education-institutional-staff-profiles-by-sex-and-gender-2023/",
     "Annual HEA publication of Irish HEI staff headcount by grade, gender, and contract type",
     ["hea_staff_profile", "workforce_summary"]),
    ("CSO Earnings and Labour Costs Q4 2024", "Real", 2024,
     "https://www.cso.ie/en/releasesandpublications/ep/p-elc/earningsandlabourcostsq42024/",
     "CSO quarterly earnings by sector including education sector hourly and weekly averages",
     ["cso_earnings_benchmark", "employees"]),
    ("Irish Gender Pay Gap Information Act 2021 benchmarks", "Real", 2023,
     "https://www.gov.ie/en/publication/173e5-gender-pay-gap-information/",
     "Published HEI sector GPG disclosure benchmarks",
     ["gpg_benchmarks"]),
    ("Synthetic individual-level HR records", "Synthetic", 2024, None,
     "Generated using Faker + NumPy, calibrated to HEA 2023 gender/grade/contract distributions",
     ["employees", "absences", "recruitment", "leavers", "training"]),
]


def staff_profile(spark: SparkSession, institution: str, year: int = 2023) -> DataFrame:
    """Published headcount by grade, gender and contract: whole people, so each share is rounded half-even."""
    grades = spark.createDataFrame(
        [(c, g, n, Decimal(s), Decimal(FTE_RATES[c])) for c, g, n, s in STAFF_PROFILE_GRADES],
        "staff_category string, grade string, total int, female_share decimal(3,2), fte_rate decimal(3,2)",
    )
    women = F.bround(F.col("total") * F.col("female_share"), 0).cast("int")
    by_gender = grades.withColumn("women", women).select(
        "*",
        F.explode(
            F.array(
                F.struct(F.lit("Female").alias("gender"), F.col("women").alias("people")),
                F.struct(F.lit("Male").alias("gender"), (F.col("total") - F.col("women")).alias("people")),
            )
        ).alias("g"),
    )
    contracts = [
        F.struct(F.lit(name).alias("contract_type"), F.lit(Decimal(share)).alias("share"))
        for name, share in CONTRACT_SHARES.items()
    ]
    headcount = F.bround(F.col("g.people") * F.col("c.share"), 0).cast("int")
    return (
        by_gender.withColumn("c", F.explode(F.array(*contracts)))
        .select(
            F.lit(institution).alias("institution"),
            F.lit(year).alias("year"),
            "staff_category",
            "grade",
            "g.gender",
            headcount.alias("headcount"),
            "c.contract_type",
            F.bround(headcount * F.col("fte_rate"), 1).cast("decimal(8,1)").alias("fte"),
        )
        .filter(F.col("headcount") != 0)
    )


def earnings(spark: SparkSession) -> DataFrame:
    rows = [(y, q, s, Decimal(h), Decimal(w), Decimal(c), u) for y, q, s, h, w, c, u in EARNINGS_ROWS]
    return spark.createDataFrame(rows, schemas.EARNINGS)


def pay_gap(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(s, m, Decimal(v), d, n) for s, m, v, d, n in PAY_GAP_ROWS], schemas.PAY_GAP)


def data_sources(spark: SparkSession) -> DataFrame:
    rows = [(*r, None) for r in DATA_SOURCE_ROWS]
    return spark.createDataFrame(rows, schemas.DATA_SOURCES).withColumn("created_at", F.current_timestamp())


def sources_of(data_sources: DataFrame, table: str) -> DataFrame:
    """The provenance rows that name a table."""
    return data_sources.filter(F.array_contains("tables_populated", table))
