"""Lists of possible partners, and the pairs and blocks in which they are compared.

Links are only needed to know components. So a list is first held against one hub of it, and only
lists that are still in several components are compared in full, in blocks of bounded size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.session import cut_lineage

HUB_SALTS = 4             # different hubs a group of lists gets
BLOCK_MASS = 500_000      # mass a block of a list holds


def shared_lists(posted: DataFrame) -> DataFrame:
    """list, node, mass, hub of (key: bigint, node: bigint, mass: bigint), each row given once.

    Keys of one node vanish; keys of the same nodes are one list. `hub` marks one member a list.
    """
    place = F.xxhash64("node", F.pmod("key", F.lit(HUB_SALTS)))
    lists = posted.groupBy("key").agg(
        F.count(F.lit(1)).alias("c"), F.bit_xor(F.xxhash64("node")).alias("x"),
        F.bit_xor(F.xxhash64("node", F.lit("again"))).alias("y"), F.min(place).alias("at"))
    once = lists.filter("c > 1").groupBy("c", "x", "y").agg(F.min(F.struct("key", "at")).alias("l"))
    return posted.join(once.select("l.*"), "key").select(
        F.col("key").alias("list"), "node", "mass", (place == F.col("at")).alias("hub"))


def distinct_lists(members: DataFrame) -> DataFrame:
    """One list of each set of nodes; the columns of `members`."""
    marks = members.groupBy("list").agg(
        F.count(F.lit(1)).alias("c"), F.bit_xor(F.xxhash64("node")).alias("x"),
        F.bit_xor(F.xxhash64("node", F.lit("again"))).alias("y"))
    once = marks.groupBy("c", "x", "y").agg(F.min("list").alias("list")).select("list")
    return members.join(once, "list")


def hub_pairs(members: DataFrame) -> DataFrame:
    """(a, b), a below b: every member of a list with the list's hub, each pair once."""
    hubs = members.filter("hub").select("list", F.col("node").alias("with"))
    return members.join(hubs, "list").filter(F.col("node") != F.col("with")).select(
        F.least("node", "with").alias("a"), F.greatest("node", "with").alias("b")).distinct()


def open_blocks(members: DataFrame, found: DataFrame, least: int = 3,
                block_mass: int | None = None) -> DataFrame:
    """list, o, i, outer, node, component: what is left to compare after `found` (node, component).

    `list` is a list's number or, where its lists are compared as one, their largest component's.

    Of each list with more than one component, the nodes outside the largest one (outer) meet all
    nodes of the list (inner). Both sides are dealt into blocks of about `block_mass` by a hash,
    and the rows of (list, o, i) are one pair of blocks. Lists below `least` nodes are left out: their
    hub has met all of them.
    """
    limit = block_mass or BLOCK_MASS
    parts = cut_lineage(members.join(found, "node", "left").select(
        "list", "node", "mass", F.coalesce("component", "node").alias("component")))
    shares = parts.groupBy("list", "component").agg(F.count(F.lit(1)).alias("c"))
    lists = shares.groupBy("list").agg(
        F.max(F.struct("c", "component")).alias("top"), F.count(F.lit(1)).alias("parts"),
        F.sum("c").alias("size")).filter(f"parts > 1 AND size >= {least}")
    lists = cut_lineage(lists.select("list", F.col("top.component").alias("largest"), (
        F.col("size") * (F.col("size") - F.col("top.c"))).cast("double").alias("pairs")))
    rows = parts.join(lists.select("list", "largest"), "list")

    # Lists around one component mostly repeat each other: as one list they need fewer pairs.
    union = cut_lineage(rows.select("largest", "node", "mass", "component").distinct())
    outside = F.col("component") != F.col("largest")
    merged = union.groupBy("largest").agg(
        (F.count(F.lit(1)) * F.count_if(outside)).cast("double").alias("together")).join(
        lists.groupBy("largest").agg(F.sum("pairs").alias("pairs")), "largest").filter(
        "together <= pairs").select("largest")
    merged = cut_lineage(merged)
    rows = union.join(merged, "largest").select(
        F.col("largest").alias("list"), "largest", "node", "mass", "component").unionByName(
        rows.join(merged, "largest", "left_anti").select("list", "largest", "node", "mass", "component"))

    sums = rows.groupBy("list", "largest").agg(
        F.ceil(F.sum("mass") / limit).cast("int").alias("blocks"),
        F.ceil(F.sum(F.when(outside, F.col("mass"))) / limit).cast("int").alias("outer_blocks"))
    rows = rows.join(sums, ["list", "largest"])
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    rest = F.pmod(F.xxhash64("node"), F.col("outer_blocks")).cast("int")
    inner = F.transform(F.sequence(F.lit(0), F.col("outer_blocks") - 1), lambda o: F.struct(
        o.alias("o"), block.alias("i"), F.lit(False).alias("outer")))
    outer = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda i: F.struct(
        rest.alias("o"), i.alias("i"), F.lit(True).alias("outer")))
    return rows.select("list", "node", "component", F.explode(F.when(
        outside, F.concat(inner, outer)).otherwise(inner)).alias("at")).select(
        "list", "at.*", "node", "component")
