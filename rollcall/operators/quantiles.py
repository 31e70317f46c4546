"""Exact medians, percentiles and quartiles without a global sort and without one task per group.

Values are counted, counts are added up per value bucket, and only the buckets that hold a wanted rank are opened.
Each step works on counts, so its size depends on the number of distinct values and buckets, not on rows, and a
group that holds most rows costs no more than any other.
"""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, IntegralType

from rollcall.operators.rollup import join_groups

MEDIAN = {"median": "0.5"}
NO_TOTAL = "CAST(NULL AS DECIMAL(20,2))"
QUARTILES = {"q1": "0.25", "median": "0.5", "q3": "0.75"}


def _scale(df: DataFrame, value: str) -> int:
    """Decimals of a whole or decimal column. Others can't be added up and interpolated exactly, so they are refused."""
    kind = df.select(value).schema[0].dataType
    if isinstance(kind, IntegralType):
        return 0
    if isinstance(kind, DecimalType):
        return kind.scale
    raise TypeError(f"{value}: whole or decimal numbers are needed, not {kind.simpleString()}")


def thousands(value: Column) -> Column:
    """Bucket for pay and day counts: at most 100,000 cents or 1,000 days fall into one."""
    return F.floor(value / 1000).cast("bigint")


def leading_digits(value: Column) -> Column:
    """Bucket for long-tailed values, in value order: length and first four digits of the whole part, mirrored below 0."""
    digits = F.abs(value).cast("decimal(38,0)").cast("string")
    size = F.length(digits) * 10000 + F.substring(digits, 1, 4).cast("int")
    return F.when(value < 0, -size).otherwise(size)


def _count(keyed: DataFrame) -> DataFrame:
    """Rows per group, bucket and value.

    The filter is the one the join in ``_locate`` would push into one of the two uses of these counts only; stated for
    both, the plans are equal and the counts are made once.
    """
    return keyed.filter("bucket is not null").groupBy("g", "bucket", "v").agg(F.count(F.lit(1)).alias("n"))


def _locate(counts: DataFrame, wanted: Callable[[Column], Column]) -> DataFrame:
    """Find the values at wanted ranks.

    ``counts`` has a group ``g`` that is never NULL, ``bucket``, ``v``, ``n`` and ``v_total``; buckets follow the order
    of the values. ``wanted`` turns the group's row count into an array of (target, rank), ranks from 0. Gives one row
    per target found: the group's totals, the target, its value and the rank the value starts at.
    """
    buckets = counts.groupBy("g", "bucket").agg(
        F.expr("sum(n) AS bucket_n"),
        F.expr("sum(v_total) AS bucket_total"),
        F.expr("min(v) AS bucket_min"),
        F.expr("max(v) AS bucket_max"),
    )
    upto = "PARTITION BY g ORDER BY bucket ROWS UNBOUNDED PRECEDING"
    placed = buckets.selectExpr(
        "g",
        "bucket",
        "bucket_n",
        f"sum(bucket_n) OVER ({upto}) - bucket_n AS first_rank",
        "sum(bucket_n) OVER (PARTITION BY g) AS n_all",
        "sum(bucket_total) OVER (PARTITION BY g) AS total_all",
        "min(bucket_min) OVER (PARTITION BY g) AS min_all",
        "max(bucket_max) OVER (PARTITION BY g) AS max_all",
    )
    inside = "t -> t.rank >= first_rank AND t.rank < first_rank + bucket_n"
    opened = placed.withColumn("targets", wanted(F.col("n_all"))).selectExpr(
        "g", "bucket", "first_rank", "n_all", "total_all", "min_all", "max_all", f"inline(filter(targets, {inside}))"
    )
    within = "PARTITION BY g, bucket, target ORDER BY v ROWS UNBOUNDED PRECEDING"
    return (
        counts.drop("v_total")
        .join(opened, ["g", "bucket"])
        .selectExpr("*", f"first_rank + sum(n) OVER ({within}) - n AS start")
        .filter("start <= rank AND rank < start + n")
    )


def distribution(
    df: DataFrame,
    by: list[str],
    value: str,
    percentiles: dict[str, str] = MEDIAN,
    bucket: Callable[[Column], Column] = thousands,
    with_total: bool = True,
) -> DataFrame:
    """Count, total, smallest, largest and interpolated percentiles of a numeric column, exact, per group.

    NULL values are skipped; a group without values gives no row. Percentiles come out as decimals, and no decimal of the
    column is cut. Values too large to be added up in 20 digits are taken without a total.
    """
    v, scale = F.col(value), _scale(df, value)
    # A struct of the keys is one key in which NULL is a value like any other.
    group = F.struct(*by) if by else F.lit(0)
    keyed = df.filter(v.isNotNull()).select(group.alias("g"), bucket(v).alias("bucket"), v.alias("v"))
    total = f"CAST(v AS DECIMAL(20,{max(2, scale)})) * n" if with_total else NO_TOTAL
    counts = _count(keyed).withColumn("v_total", F.expr(total))

    def position(n, p):
        return (n - 1).cast("decimal(20,0)") * F.lit(Decimal(p)).cast("decimal(6,5)")

    def wanted(n):
        ends = []
        for name, p in percentiles.items():
            at = position(n, p)
            ends.append(F.struct(F.lit(f"{name} lo").alias("target"), F.floor(at).cast("bigint").alias("rank")))
            ends.append(F.struct(F.lit(f"{name} hi").alias("target"), F.ceil(at).cast("bigint").alias("rank")))
        return F.array(*ends)

    exact = f"decimal(30,{max(2, scale)})"

    def interpolated(name, p):
        lo = F.max(F.when(F.col("target") == f"{name} lo", F.col("v"))).cast(exact)
        hi = F.max(F.when(F.col("target") == f"{name} hi", F.col("v"))).cast(exact)
        at = position(F.max("n_all"), p)
        part = (at - F.floor(at)).cast("decimal(6,5)")
        return (lo + (hi - lo) * part).alias(name)

    found = (
        _locate(counts, wanted)
        .groupBy("g")
        .agg(
            F.max("n_all").alias("n"),
            F.max("total_all").alias("total"),
            F.max("min_all").alias("min"),
            F.max("max_all").alias("max"),
            *[interpolated(name, p) for name, p in percentiles.items()],
        )
    )
    return found.select("g.*", *found.columns[1:]) if by else found.drop("g")


def box_summary(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """Five-number summary, and the outermost values within 1.5 interquartile ranges of the box."""
    box = distribution(df, by, value, QUARTILES)
    reach = (F.col("q3") - F.col("q1")) * F.lit(Decimal("1.5"))
    fences = box.select(*by, (F.col("q1") - reach).alias("low_fence"), (F.col("q3") + reach).alias("high_fence"))
    rows = df.filter(F.col(value).isNotNull()).groupBy(*by, value).agg(F.lit(1).alias("seen"))
    whiskers = (
        join_groups(rows, fences, by)
        .filter(F.col(value).between(F.col("low_fence"), F.col("high_fence")))
        .groupBy(*by)
        .agg(F.min(value).alias("whisker_low"), F.max(value).alias("whisker_high"))
    )
    return join_groups(box, whiskers, by)


def ntile_starts(n: Column, buckets: int) -> list[Column]:
    """First rank of each bucket after the first, as SQL deals rows out: the first buckets take the remainder."""
    size, extra = F.floor(n / buckets), n % buckets
    return [(size * k + F.least(F.lit(k), extra)).cast("bigint") for k in range(1, buckets)]


def slice_starts(n: Column, buckets: int) -> list[Column]:
    """First position of each slice after the first, when slices are cut at k*n/buckets rounded down."""
    return [F.floor(n * k / buckets).cast("bigint") for k in range(1, buckets)]


def assign_quartile(
    df: DataFrame,
    value: str,
    key: str,
    name: str = "quartile",
    buckets: int = 4,
    starts: Callable[[Column, int], list[Column]] = ntile_starts,
) -> DataFrame:
    """Number the rows 1..buckets by rising value, as a window over the whole table would.

    Rows with equal values follow each other by md5 of the key, then by key. The rows where buckets begin are found
    by counting: per value, then per md5 prefix among the rows at those few values, then within those few prefixes.
    Every row is then numbered by comparing it with these rows, in place and without being shuffled. Rows of one value and
    key are not told apart and go into the same bucket.
    """
    rows = df.filter(F.col(value).isNotNull()).select(F.col(value).alias("v"), F.col(key).alias("k"))
    keyed = rows.select(F.lit(0).alias("g"), thousands(F.col("v")).alias("bucket"), "v")
    counts = _count(keyed).withColumn("v_total", F.expr(NO_TOTAL))

    def wanted(n):
        firsts = starts(n, buckets)
        return F.array(*[F.struct(F.lit(i).alias("target"), r.alias("rank")) for i, r in enumerate(firsts)])

    # a row for each value that holds a wanted rank: fewer than buckets
    places = F.collect_list(F.struct("target", (F.col("rank") - F.col("start")).alias("rank")))
    at_values = _locate(counts, wanted).groupBy(F.col("v").alias("value")).agg(places.alias("places"))
    # counts by prefix are 65,536 for each of these values at the most, so that one window may go over them
    upto = "PARTITION BY value ORDER BY prefix ROWS UNBOUNDED PRECEDING"
    at_prefixes = (
        rows.join(F.broadcast(at_values), F.expr("v = value"))
        .groupBy("value", F.expr("substring(md5(k), 1, 4) AS prefix"), "places")
        .agg(F.count(F.lit(1)).alias("n"))
        .selectExpr("value", "prefix", "n", f"sum(n) OVER ({upto}) - n AS start", "places")
        .selectExpr("value", "prefix", "start", "inline(filter(places, p -> p.rank >= start AND p.rank < start + n))")
        .selectExpr("target", "value", "prefix", "rank - start AS rank")
    )
    last = (
        rows.withColumn("h", F.md5("k"))
        .join(F.broadcast(at_prefixes), F.expr("v = value AND prefix <=> substring(h, 1, 4)"))
        .selectExpr("v", "k", "h", "rank", "row_number() OVER (PARTITION BY target ORDER BY h, k) - 1 AS place")
    )
    cuts = _few(last.filter("place = rank").selectExpr("named_struct('v', v, 'h', h, 'k', k) AS at"))

    v, k = F.col(value), F.col(key)

    def reached(cut):
        tie = F.struct(F.md5(k).alias("h"), k.alias("k")) >= F.struct(cut["h"].alias("h"), cut["k"].alias("k"))
        return F.when(cut.isNull(), 0).when(v > cut["v"], 1).when(v < cut["v"], 0).otherwise(tie.cast("int"))

    passed = sum((reached(F.get("cuts", F.lit(i))) for i in range(buckets - 1)), F.lit(1))
    return df.withColumn("cuts", cuts.scalar()).withColumn(name, F.when(v.isNotNull(), passed)).drop("cuts")


def _few(found: DataFrame) -> DataFrame:
    """The rows where buckets begin, as one array: one per bucket at most."""
    return found.agg(F.collect_list("at").alias("at"))


def histogram(df: DataFrame, value: str, bins: int = 40) -> DataFrame:
    """Equal-width bins from the smallest to the largest whole value, the last one closed, empty bins included."""
    span = df.agg(F.struct(F.min(value).alias("lo"), F.max(value).alias("hi")).alias("span")).scalar()
    counted = (
        df.filter(F.col(value).isNotNull())
        .groupBy(F.col(value).cast("decimal(36,0)").alias("v"))
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("lo", span["lo"].cast("decimal(36,0)"))
        .withColumn("hi", span["hi"].cast("decimal(36,0)"))
    )
    # With a single value the range is widened by one half on each side, which puts it in the middle bin.
    bin_no = F.when(F.col("lo") == F.col("hi"), F.lit(bins // 2)).otherwise(
        F.least(F.expr(f"(v - lo) * {bins} div greatest(hi - lo, 1)"), F.lit(bins - 1))
    )
    filled = counted.groupBy(bin_no.cast("int").alias("bin")).agg(F.sum("n").alias("found"))
    single = span["lo"] == span["hi"]
    low = F.when(single, span["lo"].cast("double") - 0.5).otherwise(span["lo"].cast("double"))
    width = F.when(single, F.lit(1.0)).otherwise((span["hi"] - span["lo"]).cast("double"))
    spine = df.sparkSession.range(bins, numPartitions=1).select(F.col("id").cast("int").alias("bin"))
    return spine.join(filled, "bin", "left").select(
        "bin",
        (low + F.col("bin") * width / bins).alias("bin_lo"),
        (low + (F.col("bin") + 1) * width / bins).alias("bin_hi"),
        F.coalesce("found", F.lit(0)).alias("count"),
    )
