"""Connected components of a graph that is too large for one machine: large-star and small-star rounds in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.llm.common import keep_table


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(id, component) of every id in `links` (a, b): the smallest id that can be reached.

    Each round hangs every neighbour larger than an id on the smallest in its neighbourhood, then does the same with the
    smaller ones. Both steps group and join on the id; the smallest neighbour is found with map-side aggregation, and the
    joins end a stage, so adaptive execution may split an id with many links. Rounds grow with the logarithm of the
    longest chain.
    """
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges, before = keep_table(edges, "edges"), None
    for _ in range(most_rounds):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = keep_table(large.where("u <> v").distinct(), "large_star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        edges = keep_table(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "small_star")
        state = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError(f"components: not settled after {most_rounds} rounds")
    roots = edges.select("v").distinct().select(F.col("v").alias("id"), F.col("v").alias("component"))
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots)
