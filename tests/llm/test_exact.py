import hashlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from rollcall.llm import exact, queries
from rollcall.llm.common import bit_plane
from tests.conftest import rows
from tests.llm.conftest import SMALL


def test_agrees_with_sql_on_whole_tables(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{SMALL}/documents.parquet'")
    wanted = con.sql(queries.SQL["op2_exact_dedup"]).fetchall()
    assert sorted(rows(queries.op2_exact_dedup(spark, SMALL))) == sorted(wanted)


@pytest.mark.parametrize("max_cells", [32, 64, 1 << 10, 1 << 30])
def test_odd_rows_at_any_size_of_the_filter(odd, max_cells):
    got = sorted(rows(exact.exact_groups(odd, max_cells=max_cells)), key=str)
    by = {}
    for key, keep, size, kept, sha in got:
        by.setdefault(key, []).append((keep, size, kept, sha))
    seven = hashlib.sha256(b"one two three four five six seven").hexdigest()
    assert by[1] == [(2, 3, False, seven)] and by[2] == [(2, 3, True, seven)] * 2
    empty = hashlib.sha256(b"").hexdigest()
    assert by[3] == [(4, 3, False, empty)] and by[4] == [(4, 3, True, empty)] and (4, 3, False, empty) in by[None]
    assert by[5][0][1] == 1 and by[7][0][2] and len(got) == odd.count()


@pytest.mark.parametrize("max_cells", [64, 1 << 30])
def test_rows_that_stay_keep_all_columns(odd, max_cells):
    left = exact.without_copies(odd, max_cells=max_cells)
    assert left.columns == odd.columns
    assert sorted((r["doc_id"] for r in left.collect()), key=str) == sorted([2, 4, 5, 6, 7, None], key=str)
    again = exact.without_copies(left)
    assert again.count() == 6


def test_empty_table(nothing):
    assert rows(exact.exact_groups(nothing)) == [] and rows(exact.without_copies(nothing)) == []


def test_a_cell_is_repeated_only_if_two_rows_mark_it(spark):
    plane = bit_plane(spark.createDataFrame([(0,), (33,), (1023,)], "cell long"), 1024)
    assert plane[0] == 1 and plane[1] == 2 and plane[31] == 1 << 31 and plane.sum() == 3 + (1 << 31)


def test_only_possibly_repeated_rows_shuffle(spark):
    df = spark.range(4000).selectExpr("id AS doc_id", "concat('text ', if(id % 100 = 0, 0, id)) AS text")
    got = exact.exact_groups(df)
    assert got.filter("group_size = 40").count() == 40 and got.filter("kept").count() == 3961
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Union" in plan and "Filter NOT" in plan


def test_marks_are_merged_by_word():
    words = np.array([5, 2, 5, 5, 2], np.int64)
    once = np.array([0b0011, 0b1, 0b0110, 1 << 63, 0b1], np.uint64)
    twice = np.array([0, 0, 0b1000, 0, 0], np.uint64)
    got = [x.tolist() for x in exact.merge(words, once, twice)]
    assert got == [[2, 5], [0b1, 0b0111 | 1 << 63], [0b1, 0b1010]]


def test_several_filters_suspect_no_more_than_one(spark):
    df = spark.range(40_000, numPartitions=5).selectExpr("id", "unhex(sha2(string(if(id % 50 = 0, 0, id)), 256)) AS sha")
    shares = []
    for most in (1 << 30, 1 << 15):  # one filter of 2^20 cells; 20 of 2^15
        tested = exact.Tested(df, 16, most)
        lost = F.expr("count_if(id % 50 = 0 and not maybe)").alias("lost")
        found = tested.flagged.agg(F.count_if("maybe").alias("n"), lost).first()
        assert found["lost"] == 0 and tested.flagged.count() == 40_000
        shares.append(found["n"] / 40_000)
    assert tested.filters == exact.Filters(20, 1 << 15)
    assert all(0.02 <= share < 0.03 for share in shares)  # 1 in 50 is repeated
