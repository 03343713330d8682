"""Connected components of an edge table by star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe import config
from riskframe.session import cut_lineage


def components(edges: DataFrame) -> DataFrame:
    """node, component (smallest node reachable) for every node of `edges` (a, b: bigint).

    Each round links neighbours to the smallest neighbour, first from every node to its larger
    ones, then among its smaller ones. Rounds grow with the logarithm of the longest path, edges
    do not grow in number, and a hub of millions of edges is one row per edge: minima are combined
    before the shuffle and adaptive execution splits its join. Only a count and a checksum reach
    the driver. Loops and repeated edges do no harm; an empty table gives no rows.
    """
    now = cut_lineage(edges.filter("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    # Few edges, no more than may be broadcast, need no shuffles: those would cost more than the work.
    few = now.count() <= config.MAX_BROADCAST_ROWS
    state = None
    while True:
        now = now.coalesce(1) if few else now
        both = now.select(F.explode(F.array(
            F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("e")).select("e.*")
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = cut_lineage(large.filter("a <> b").distinct())
        large = large.coalesce(1) if few else large
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(
            F.explode(F.array(F.struct("a", "m"), F.struct(F.col("b").alias("a"), "m"))).alias("e"))
        now = cut_lineage(small.select(F.col("e.a"), F.col("e.m").alias("b")).filter(
            "a <> b").distinct())
        check = now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if check == state:
            break
        state = check
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
