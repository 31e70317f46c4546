import random
from decimal import Decimal

import hashlib
import numpy as np
import pytest
from pyspark.sql import functions as F

from rollcall.operators import quality, quantiles, rollup
from tests.conftest import keyed, rows


def percentile(values, p):
    values = sorted(values)
    at = Decimal(p) * (len(values) - 1)
    lo, part = int(at), at - int(at)
    hi = min(lo + (1 if part else 0), len(values) - 1)
    return values[lo] + (values[hi] - values[lo]) * part


@pytest.mark.parametrize("seed, size", [(1, 1), (2, 2), (3, 5), (4, 400), (5, 1501)])
def test_distribution_equals_sorting(spark, seed, size):
    rnd = random.Random(seed)
    data = [
        (rnd.choice(["a", "b", None]), Decimal(rnd.choice([30000, 30000, rnd.randint(-99999, 9999999)])) / 100)
        for _ in range(size)
    ]
    df = spark.createDataFrame([*data, ("a", None)], "g string, v decimal(10,2)")
    got = keyed(quantiles.distribution(df, ["g"], "v", {"q1": "0.25", "median": "0.5", "p9": "0.9"}), "g")
    for g in {g for g, _ in data}:
        values = [v for key, v in data if key == g]
        assert got[g]["n"] == len(values) and got[g]["total"] == sum(values)
        assert got[g]["min"] == min(values) and got[g]["max"] == max(values)
        for name, p in (("q1", "0.25"), ("median", "0.5"), ("p9", "0.9")):
            assert got[g][name] == percentile(values, p), (g, name)
    assert set(got) == {g for g, _ in data}


def test_distribution_without_groups_and_long_tail(spark):
    values = [0, 1, 5, 99, 100, 1000, 10**6, 10**15, 3 * 10**27]
    df = spark.createDataFrame([(Decimal(v),) for v in values], "v decimal(38,0)")
    got = quantiles.distribution(df, [], "v", bucket=quantiles.leading_digits, with_total=False).first()
    assert got["median"] == 100 and got["n"] == 9 and got["max"] == 3 * 10**27


def test_leading_digits_follow_the_values(spark):
    values = [0, 1, 9, 10, 99, 100, 999, 1000, 9999, 10000, 12345, 12350, 99999, 10**9, 10**12 + 1]
    df = spark.createDataFrame([(i, Decimal(v)) for i, v in enumerate(values)], "i int, v decimal(38,0)")
    buckets = [r[0] for r in rows(df.orderBy("i").select(quantiles.leading_digits(F.col("v"))))]
    assert buckets == sorted(buckets)


def test_leading_digits_follow_values_below_zero(spark):
    values = [-(10**12), -99999, -12350, -12345, -10, -9, -5, -1, 0, 1, 5, 9, 10, 12345]
    df = spark.createDataFrame([(i, Decimal(v)) for i, v in enumerate(values)], "i int, v decimal(38,0)")
    buckets = [r[0] for r in rows(df.orderBy("i").select(quantiles.leading_digits(F.col("v"))))]
    assert buckets == sorted(buckets)
    scores = spark.createDataFrame([(Decimal(v),) for v in (-5, 3, 7)], "v decimal(38,0)")
    assert quantiles.distribution(scores, [], "v", bucket=quantiles.leading_digits, with_total=False).first()["median"] == 3


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("bucket", [quantiles.thousands, quantiles.leading_digits])
def test_percentiles_of_four_decimals_and_negatives_equal_sorting(spark, seed, bucket):
    rnd = random.Random(seed)
    values = [Decimal(rnd.randint(-10**8, 10**8)) / 10000 for _ in range(rnd.randint(1, 300))]
    df = spark.createDataFrame([(v,) for v in values], "v decimal(18,4)")
    got = quantiles.distribution(df, [], "v", {"q1": "0.25", "median": "0.5", "p9": "0.9"}, bucket=bucket).first()
    assert got["total"] == sum(values)
    for name, p in (("q1", "0.25"), ("median", "0.5"), ("p9", "0.9")):
        assert got[name] == percentile(values, p), name


def test_percentiles_refuse_floating_point(spark):
    with pytest.raises(TypeError, match="whole or decimal"):
        quantiles.distribution(spark.createDataFrame([(1.5,)], "v double"), [], "v")


def test_stitch_refuses_a_measure_of_two_frames(spark):
    df = spark.createDataFrame([("x", 1)], "k string, a int")
    with pytest.raises(ValueError, match="more than one frame: a"):
        rollup.stitch(["k"], df, df)


def test_distribution_of_nothing(spark):
    df = spark.createDataFrame([], "g string, v decimal(10,2)")
    assert rows(quantiles.distribution(df, ["g"], "v")) == []


def in_order(data):
    return sorted(data, key=lambda r: (r[1], hashlib.md5(r[0].encode()).hexdigest(), r[0]))


def ntile(n, buckets=4):
    size, extra = divmod(n, buckets)
    return [b + 1 for b in range(buckets) for _ in range(size + (b < extra))]


@pytest.mark.parametrize("n", [0, 1, 2, 3, 4, 5, 7, 10, 59, 400, 1502])
def test_quartiles_equal_a_global_window(spark, n):
    rnd = random.Random(n)
    # A third of the rows share one value, so a boundary falls inside a large tie.
    data = [(f"E{i}", Decimal(rnd.choice([500, rnd.randint(100, 900), rnd.randint(100, 900)]))) for i in range(n)]
    df = spark.createDataFrame(data, "k string, v decimal(10,2)").repartition(5)
    ordered = in_order(data)
    got = dict(rows(quantiles.assign_quartile(df, "v", "k"), "k", "quartile"))
    assert got == {k: q for (k, _), q in zip(ordered, ntile(n))}
    sliced = dict(rows(quantiles.assign_quartile(df, "v", "k", starts=quantiles.slice_starts), "k", "quartile"))
    wanted = {}
    for i in range(4):
        for k, _ in ordered[i * n // 4 : (i + 1) * n // 4]:
            wanted[k] = i + 1
    assert sliced == wanted


def test_quartiles_when_all_values_are_equal(spark):
    data = [(f"E{i}", Decimal(7)) for i in range(1001)]
    df = spark.createDataFrame(data, "k string, v decimal(10,2)")
    got = dict(rows(quantiles.assign_quartile(df, "v", "k"), "k", "quartile"))
    assert got == {k: q for (k, _), q in zip(in_order(data), ntile(1001))}


def test_quartile_ignores_missing_values(spark):
    df = spark.createDataFrame([("a", Decimal(1)), ("b", None)], "k string, v decimal(10,2)")
    assert dict(rows(quantiles.assign_quartile(df, "v", "k"), "k", "quartile")) == {"a": 1, "b": None}


@pytest.mark.parametrize("values", [[3], [0, 40], [1, 1, 1], [5, 17, 80, 81, 400, 401, 402, 1000], list(range(0, 97, 3))])
def test_histogram_is_numpys(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v bigint")
    counts, edges = np.histogram(values, bins=40)
    got = rows(quantiles.histogram(df, "v").orderBy("bin"))
    assert [r[3] for r in got] == list(counts)
    assert [r[1] for r in got] == pytest.approx(list(edges[:-1])) and got[-1][2] == pytest.approx(edges[-1])


def test_box_summary(spark):
    values = [1, 10, 11, 12, 13, 14, 60]
    df = spark.createDataFrame([("g", v) for v in values] + [("h", 5), (None, 2), (None, 4)], "g string, v int")
    got = keyed(quantiles.box_summary(df, ["g"], "v"), "g")
    assert (got["g"]["q1"], got["g"]["median"], got["g"]["q3"]) == (Decimal("10.5"), 12, Decimal("13.5"))
    assert (got["g"]["whisker_low"], got["g"]["whisker_high"]) == (10, 14)
    assert got["h"]["whisker_low"] == 5 and got[None]["median"] == 3


def test_by_attribute_keeps_unknown_employees_when_asked(spark):
    people = spark.createDataFrame([("1", "X"), ("2", "Y"), ("3", None)], "employee_id string, department string")
    fact = spark.createDataFrame([("1", 5), ("1", 6), ("3", 1), ("9", 7), (None, 2)], "employee_id string, days int")
    sums = {"n": F.count("*"), "days": F.sum("days")}
    assert sorted(rows(rollup.by_attribute(fact, people, ["department"], sums)), key=str) == [("X", 2, 11), (None, 1, 1)]
    left = rollup.by_attribute(fact, people, ["department"], sums, how="left")
    assert sorted(rows(left), key=str) == [("X", 2, 11), (None, 3, 10)]
    assert rows(rollup.by_attribute(fact, people, [], sums)) == [(5, 21)]


def test_stitch_is_a_full_join_with_null_keys(spark):
    a = spark.createDataFrame([("x", 1), (None, 2)], "k string, a int")
    b = spark.createDataFrame([("y", 3), (None, 4)], "k string, b int")
    assert sorted(rows(rollup.stitch(["k"], a, b)), key=str) == [("x", 1, None), ("y", None, 3), (None, 2, 4)]


@pytest.mark.parametrize("null_breaks", [False, True])
def test_orphans_with_hot_and_missing_keys(spark, null_breaks):
    child = spark.createDataFrame(
        [(i, "bad" if i % 3 == 0 else None if i % 3 == 1 else str(i % 7)) for i in range(600)], "id int, k string"
    )
    parent = spark.createDataFrame([(str(i),) for i in range(6)], "k string")
    marked = rows(quality.mark_orphans(child, "k", parent, "k", "unknown", "id", null_breaks))
    assert len(marked) == 600 and len({r[0] for r in marked}) == 600
    assert all(unknown == (null_breaks if k is None else k in ("bad", "6")) for _, k, unknown in marked)


def test_a_hot_reference_is_split_over_tasks(spark):
    small = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    }
    before = {k: spark.conf.get(k, None) for k in small}
    try:
        for k, v in small.items():
            spark.conf.set(k, v)
        child = spark.range(200_000, numPartitions=8).select(
            F.col("id"), F.when(F.col("id") % 2 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k")
        )
        parent = spark.range(20_000).select(F.col("id").cast("string").alias("p"))
        marked = quality.mark_orphans(child, "k", parent, "p", "unknown", "id").filter("unknown").select("id", "k")
        assert len(marked.collect()) == 190_000
        assert "skew=true" in marked._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_rules_report_and_flags(spark):
    df = spark.createDataFrame([(1, 5), (2, None), (3, 50)], "id int, v int")
    rules = [
        quality.Rule("big", F.col("v") > 10, "too_big"),
        quality.Rule("known only", F.col("v") < 6, "too_small", F.col("v").isNotNull()),
    ]
    assert [r[0] for r in rows(df.orderBy("id").select(quality.flags(rules)))] == ["too_small;", "", "too_big;"]
    got = rows(quality.report(df, "t", rules, "kept"))
    assert got == [("t", "big", 3, 1, 66.67, "kept"), ("t", "known only", 2, 1, 50.0, "kept")]
    assert rows(quality.report(df.limit(0), "t", rules, "kept"))[0][2:5] == (0, 0, 100.0)


def test_report_on_a_reference_counts_rows_not_keys(spark):
    df = spark.createDataFrame([("a", 1), ("z", 20), ("z", 3), (None, 30)], "k string, v int")
    known = spark.createDataFrame([("a",), ("a",), ("b",)], "id string")
    rules = [quality.Rule("known", F.col("unknown"), "gone", key="k"), quality.Rule("big", F.col("v") > 10)]
    assert rows(quality.report(df, "t", rules, "kept", known)) == [("t", "known", 4, 2, 50.0, "kept"), ("t", "big", 4, 2, 50.0, "kept")]
    assert [r[2:4] for r in rows(quality.report(df.limit(0), "t", rules, "kept", known))] == [(0, 0), (0, 0)]


def test_checks_let_null_pass(spark):
    df = spark.createDataFrame([("a", 1), (None, None), ("z", -1)], "w string, n int")
    assert rows(df.select(quality.not_in("w", ["a"]), quality.unless(F.col("n") > 0))) == [
        (False, False), (False, False), (True, True),
    ]


def test_duplicate_keys(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "k string")
    assert sorted(rows(quality.duplicate_keys(df, "k")), key=str) == [("a", 2), (None, 1)]


def test_quartiles_where_one_value_and_rows_without_a_key_hold_most(spark):
    """Two thirds on one value, some of them without a key: buckets are as large as NTILE's, in its order."""
    data = [(str(i), 50_000 if i % 3 else 1_000 * i) for i in range(300)] + [(None, 50_000), ("x", None)]
    df = spark.createDataFrame(data, "k string, v bigint")
    got = quantiles.assign_quartile(df, "v", "k")
    known = df.filter("v is not null").selectExpr("k", "v", "ntile(4) OVER (ORDER BY v, md5(k), k) AS quartile")
    assert sorted(rows(got.filter("v is not null"), "k", "v", "quartile"), key=str) == sorted(rows(known), key=str)
    assert rows(got.filter("v is null"), "quartile") == [(None,)]
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window") <= 6
