import pytest

SMALL = "/root/testdata/sf0.01"

#: Nulls, empty and blank texts, repeated rows, ties, and columns whose names operators might use for themselves.
ODD_ROWS = [
    (1, "one two three four five six seven", "en", "a", 1, "x"),
    (2, "one two three four five six seven", "en", "a", 1, "x"),
    (2, "one two three four five six seven", "en", "a", 1, "x"),
    (3, None, None, None, None, None),
    (4, "", "de", "b", 0, "y"),
    (5, " \t\n ", "de", "b", 3, "y"),
    (None, "a text without an id", "fr", "c", 5, "z"),
    (None, None, None, None, None, None),
    (6, "Ein Wörtchen 😀 naïve Ünïcode", "de", "b", 9, "q"),
    (7, "word " * 30_000, "en", "a", 150_000, "long"),
]
ODD_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, `score` string"
CLASHING = ("sha", "maybe", "keep", "found", "ids", "id", "rep", "page_host", "cand_id", "leak_id", "copy_id", "tox_score", "threshold")


@pytest.fixture()
def odd(spark):
    """Odd rows with clashing extra columns."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(ODD_ROWS, ODD_SCHEMA)
    return df.withColumns({c: F.lit(7) for c in CLASHING})


@pytest.fixture()
def nothing(spark):
    return spark.createDataFrame([], ODD_SCHEMA)


def documents(spark, folder=SMALL):
    return spark.read.parquet(f"{folder}/documents.parquet")


def texts_of(df):
    return {r["doc_id"]: r["text"] for r in df.select("doc_id", "text").collect()}
