import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from rollcall.functions import bands, dates, numbers, text
from tests.conftest import rows


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


@pytest.mark.parametrize(
    "n, d, places, up, even",
    [
        (1, 8, 1, 12.5, 12.5),
        (1, 16, 1, 6.3, 6.2),
        (101, 2000, 1, 5.1, 5.0),
        (2, 3, 2, 66.67, 66.67),
        (0, 5, 1, 0.0, 0.0),
        (-1, 16, 1, -6.3, -6.2),
        (5, 0, 1, None, None),
        (333333333333, 999999999999, 1, 33.3, 33.3),
    ],
)
def test_percent_rounds_exactly(spark, n, d, places, up, even):
    n, d = F.lit(n).cast("bigint"), F.lit(d).cast("bigint")
    assert one(spark, numbers.percent(n, d, places)) == up
    assert one(spark, numbers.percent(n, d, places, numbers.HALF_EVEN)) == even


def test_percent_of_nothing_is_null(spark):
    assert one(spark, numbers.percent(F.lit(1), F.lit(0))) is None
    assert one(spark, numbers.percent(F.lit(None).cast("bigint"), F.lit(5), 1)) is None
    assert one(spark, numbers.percent(F.lit(1), F.lit(3))) == 100 / 3


def test_mean_does_not_depend_on_row_order(spark):
    values = [(Decimal("0.10"),), (Decimal("1234567.89"),), (None,), (Decimal("0.01"),)] * 50
    df = spark.createDataFrame(values, "x decimal(10,2)")
    means = {
        df.orderBy(F.rand(seed)).repartition(parts).agg(numbers.mean(F.col("x"))).first()[0]
        for seed, parts in ((1, 1), (2, 7), (3, 3))
    }
    assert means == {Decimal("411522.6666666667")}
    assert df.filter("x is null").agg(numbers.mean(F.col("x"))).first()[0] is None


def test_gap_and_over(spark):
    m, f = F.lit(Decimal("60000.00")), F.lit(Decimal("50000.00"))
    assert one(spark, numbers.gap_percent(m, f, 2)) == 16.67
    assert one(spark, numbers.gap_percent(F.lit(0), f, 2)) is None
    assert one(spark, numbers.over_percent(f, m, 1)) == -16.7
    assert one(spark, numbers.over_percent(m, m, 1)) == 0.0


def test_spell_score_of_a_very_active_key(spark):
    score = numbers.spell_score(F.lit(3_000_000_000), F.lit(5_000_000_000))
    assert one(spark, score) == Decimal(3_000_000_000**2 * 5_000_000_000)


def test_text_number(spark):
    assert one(spark, numbers.text_number(F.lit(89.0), 0)) == "89"
    assert one(spark, numbers.text_number(F.lit(12.0), 1)) == "12.0"


@pytest.mark.parametrize(
    "word",
    [" fixed-term ", "IT", "HR", "End of Contract", "o'neil 3rd", "ÉIRE à la", "estates & facilities", "x--y", "", "a  b"],
)
def test_title_case_is_pythons(spark, word):
    assert one(spark, text.title_case(F.lit(word))) == word.strip().title()


def test_match_domain(spark):
    domain = ["Fixed-Term", "IT", "End of Contract"]
    values = [(" fixed-term ",), ("it",), ("End Of Contract",), ("Other ",), (None,)]
    df = spark.createDataFrame(values, "x string").select(text.match_domain(F.col("x"), domain))
    assert [r[0] for r in rows(df)] == ["Fixed-Term", "IT", "End of Contract", "Other", None]


@pytest.mark.parametrize(
    "start, as_of, years",
    [("2020-02-29", "2021-02-28", 0), ("2020-02-29", "2021-03-01", 1), ("2015-06-01", "2024-06-01", 9), ("2024-01-01", "2024-01-01", 0)],
)
def test_completed_years(spark, start, as_of, years):
    got = dates.completed_years(F.lit(dt.date.fromisoformat(start)), dt.date.fromisoformat(as_of))
    assert one(spark, got) == years


def test_month_spine(spark):
    months = [r[0] for r in rows(dates.month_spine(spark, dt.date(2020, 1, 1), dt.date(2024, 12, 1)))]
    assert len(months) == 60 and months[0] == dt.date(2020, 1, 1) and months[-1] == dt.date(2024, 12, 1)


def test_band_edges(spark):
    assert [one(spark, bands.compliance_rag(F.lit(x))) for x in (95.0, 94.9, 80.0, 79.9)] == ["GREEN", "AMBER", "AMBER", "RED"]
    assert [one(spark, bands.absence_rag(F.lit(x))) for x in (2.9, 3.0, 4.5)] == ["Green", "Amber", "Red"]
    assert [one(spark, bands.absence_rag_rule(F.lit(x))) for x in (2.9, 4.5, 4.6)] == ["Green", "Amber", "Red"]
    assert [one(spark, bands.pay_gap_rag(F.lit(x))) for x in (9.9, 10.0, 16.0, 16.1)] == ["Green", "Amber", "Amber", "Red"]
    scores = (99, 100, 449, 450)
    assert [one(spark, bands.spell_rag(F.lit(x))) for x in scores] == ["Green", "Amber", "Amber", "Red"]
    assert [one(spark, bands.spell_risk(F.lit(x))) for x in scores] == [
        "Low", "Medium", "Medium", "High — Review Recommended",
    ]
    assert [one(spark, bands.spell_band(F.lit(x))) for x in scores] == [
        "Low (0–99)", "Medium (100–449)", "Medium (100–449)", "High (450+)",
    ]
    assert [one(spark, bands.variance_class(F.lit(x))) for x in (-21, -20, -9, 9, 10)] == [
        "red", "grey", "green", "green", "grey",
    ]
    assert one(spark, bands.pay_gap_rag(F.lit(None).cast("double"))) is None
