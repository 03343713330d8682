"""Merkle manifest of a dataset: a hash tree over its rows, one proof a row.

Rows are leaves of the tree of their partition (`part_col`), in the order of their ids; the trees'
roots are the leaves of one more tree, whose root names the dataset. Every 8 consecutive nodes become
the digest of their joined digests until one is left.

1. *Ranks.* Leaves are range-sorted and written; a leaf's rank in its tree is its place within its
   task and the rows of that tree in the tasks before. No window runs over a tree.
2. *Up.* A rank's lower four digits of base 8 place a node in a block of 4096. Within its block the
   digit columns are grouped away one after the other, each time nesting the children as an array of
   structs in their parent. The rows are dealt out once, by (tree, block); the four groupings keep
   that partitioning. A block's digest is a leaf for the blocks above it.
3. *Down.* The same rollup again, now with the block's own path as one more row of its group. What
   comes out is one nested struct a block, which holds all proofs of its leaves: transforms and
   explodes emit them, no join is made.

A block is 4096 small structs at most, however large a tree is; the number of passes grows with the
logarithm of the rows. Nothing but the largest rank reaches the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.session import cut_lineage

FAN = 8               # nodes that become one
FAN_BITS = 3
BLOCK_LEVELS = 4      # levels rolled up in one block
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")

STEPS = "array<struct<l:string,r:string>>"
UP = f"struct<path:{STEPS},subroot:string,root:string>"


def field(value: Column, kind: str) -> Column:
    """A value as it enters a leaf: '-' if null, else its bytes after their number and a colon."""
    text = value if kind == "string" else value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(values: list[tuple[Column, str]]) -> Column:
    """The digest of the (value, type) of a row's columns."""
    return F.sha2(F.concat(*[field(value, kind) for value, kind in values]), 256)


def ranked(nodes: DataFrame, tree: str, order: list[str]) -> DataFrame:
    """`nodes` (written) with rank and size: the place in the `tree` by `order`, from 0, and the
    number of nodes in the tree."""
    keys = [tree, *order]
    placed = cut_lineage(nodes.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn(
        "__id", F.monotonically_increasing_id()))
    # The id has the task in its upper bits and the place in the lower 33.
    task = F.shiftright("__id", 33)
    parts = placed.groupBy(task.alias("__task"), F.col(tree).alias("__tree")).agg(
        F.count(F.lit(1)).alias("__n"), F.min("__id").alias("__from"))
    # One row per task and tree: a tree has as many rows as tasks at most.
    whole = Window.partitionBy("__tree")
    before = whole.orderBy("__task").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("__task", "__tree", "__from", F.sum("__n").over(whole).alias("size"),
                         F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    found = placed.join(parts, (task == F.col("__task")) & F.col(tree).eqNullSafe(F.col("__tree")))
    return found.select(*nodes.columns, (F.col("__before") + F.col("__id") - F.col("__from")).alias(
        "rank"), "size")


def levels_of(size: Column, most: int) -> Column:
    """Levels above the leaves of a tree of `size` leaves, up to `most`."""
    out = F.lit(0)
    for level in range(most):
        out = out + (size > F.lit(FAN ** level)).cast("int")
    return out


def digit(level: int) -> Column:
    return F.shiftright("rank", FAN_BITS * level).bitwiseAND(F.lit(FAN - 1)).cast("int")


def rolled(rows: DataFrame, payload: list[str]) -> DataFrame:
    """tree, block, up and node of each block of `rows` (tree, rank, size, digest, up, *payload).

    `node` is the block's nested struct (at, digest, kids). A row with a null rank and size is no
    node: `up` is what it brings for its `block`; elsewhere `up` is null.
    """
    block = F.coalesce("block", F.shiftright("rank", FAN_BITS * BLOCK_LEVELS))
    rows = rows.select(
        "tree", block.alias("block"), F.col("size"), "up",
        *[digit(i).alias(f"d{i}") for i in range(1, BLOCK_LEVELS)],
        F.when(F.col("rank").isNotNull(), F.struct(
            digit(0).alias("at"), F.col("digest"), *payload)).alias("node"))
    rows = rows.repartition("tree", "block")
    for level in range(BLOCK_LEVELS):
        keys = ["tree", "block", *[f"d{i}" for i in range(level + 1, BLOCK_LEVELS)]]
        rows = rows.groupBy(*keys).agg(
            F.max("size").alias("size"), F.first("up", ignorenulls=True).alias("up"),
            F.sort_array(F.collect_list("node")).alias("kids"))
        joined = F.sha2(F.array_join(F.col("kids.digest"), ""), 256)
        # A tree's only node goes up as it is.
        digest = F.when(F.col("size") > FAN ** level, joined).otherwise(F.col("kids")[0]["digest"])
        at = F.col(f"d{level + 1}") if level + 1 < BLOCK_LEVELS else F.lit(0)
        node = F.when(F.size("kids") > 0, F.struct(at.alias("at"), digest.alias("digest"), "kids"))
        rows = rows.select(*keys, "size", "up", node.alias("node"))
    return rows


def side(kids: Column, at: Column, after: bool) -> Column:
    """The joined digests of the nodes of a run before or after the one at `at`."""
    digests = F.transform(kids, lambda k: k["digest"])
    part = F.slice(digests, at + 2, FAN) if after else F.slice(digests, F.lit(1), at)
    return F.array_join(part, "")


def emitted(blocks: DataFrame, payload: list[str]) -> DataFrame:
    """tree, rank, size, digest, up (path, subroot, root), *payload of the nodes of `rolled` blocks.

    A path has, level by level, what stands before and after the node in its run.
    """
    rows = blocks.select("tree", "block", "size", "up", F.lit(0).cast("long").alias("rank"),
                         F.array().cast(STEPS).alias("path"),
                         F.col("node").alias("n"))
    for level in reversed(range(BLOCK_LEVELS)):
        step = F.struct(side(F.col("n.kids"), F.col("k.at"), False).alias("l"),
                        side(F.col("n.kids"), F.col("k.at"), True).alias("r"))
        rows = rows.select("tree", "block", "size", "up", "rank", "path", "n", F.explode("n.kids").alias("k"))
        rows = rows.select(
            "tree", "block", "size", "up", (F.col("rank") * FAN + F.col("k.at")).alias("rank"),
            F.when(F.col("size") > FAN ** level, F.concat(F.array(step), F.col("path"))).otherwise(
                F.col("path")).alias("path"), F.col("k").alias("n"))
    up = F.struct(F.concat("path", "up.path").alias("path"), F.col("up.subroot").alias("subroot"),
                  F.col("up.root").alias("root"))
    return rows.select("tree", (F.col("block") * FAN ** BLOCK_LEVELS + F.col("rank")).alias("rank"),
                       "size", F.col("n.digest").alias("digest"), up.alias("up"),
                       *[F.col(f"n.{name}").alias(name) for name in payload])


def with_paths(nodes: DataFrame, payload: list[str],
               tops: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """`nodes` (tree, rank, size, digest, *payload; written) with `up`: path, subroot and root.

    `tops` makes (tree, block: 0, up) of the trees' top nodes (tree, digest). Without, there is one
    tree and its top is the root.
    """
    chunks, most = [nodes], nodes.agg(F.max("size")).first()[0] or 1
    while len(chunks) == 1 or most > 1:
        below = chunks[-1].select("tree", "rank", "size", "digest", F.lit(None).cast("long").alias(
            "block"), F.lit(None).cast(UP).alias("up"))
        most = -(-most // FAN ** BLOCK_LEVELS)
        chunks.append(cut_lineage(rolled(below, []).select(
            "tree", F.col("block").alias("rank"), F.ceil(F.col("size") / FAN ** BLOCK_LEVELS).cast(
                "long").alias("size"), F.col("node.digest").alias("digest"))))
    if tops is None:
        given = chunks[-1].select("tree", F.lit(0).cast("long").alias("block"), F.struct(
            F.array().cast(STEPS).alias("path"), F.lit(None).cast("string").alias("subroot"),
            F.col("digest").alias("root")).alias("up"))
    else:
        given = tops(chunks[-1].select("tree", "digest"))
    for chunk in reversed(chunks[:-1]):
        kept = payload if chunk is nodes else []
        rows = chunk.select("tree", "rank", "size", "digest", *kept).unionByName(
            given, allowMissingColumns=True)
        found = emitted(rolled(rows, kept), kept)
        given = found.select("tree", F.col("rank").alias("block"), "up")
    return found


def manifest(docs: DataFrame, columns: Sequence[str] = COLUMNS, id_col: str = "doc_id", part_col: str = "lang",
             found: dict[str, Column] | None = None) -> DataFrame:
    """One row per row: id, leaf, subroot, root, proof_sha256, folded_root, verified (and path).

    `columns` enter the leaf in this order; nulls differ from empty texts. `found` has expressions
    for columns as they are met later: folded_root is the root that this row and the proof of the
    original give, verified whether it is the root. A path lists the joined digests before (l) and
    after (r) the row's own node, from its leaf to the root.

    Rows that repeat an id are leaves each, ordered by their digest; a null id comes first in its
    part, the rows without a part are the first part. Texts enter whole. Extra columns are ignored.
    An empty table gives no rows.
    """
    kinds = dict(docs.dtypes)
    later = {**{c: F.col(c) for c in columns}, **(found or {})}
    leaf = leaf_digest([(F.col(c), kinds[c]) for c in columns])
    same = F.lit(True)
    for c in found or {}:
        same = same & later[c].eqNullSafe(F.col(c))
    leaves = cut_lineage(docs.select(
        F.col(part_col).alias("tree"), F.col(id_col).alias("id"), leaf.alias("digest"),
        F.when(~same, leaf_digest([(later[c], kinds[c]) for c in columns])).alias("later")))

    def forest(subroots: DataFrame) -> DataFrame:
        roots = subroots.select(F.lit(0).alias("tree"), F.col("tree").alias("part"), "digest")
        placed = cut_lineage(ranked(roots, "tree", ["part"]))
        return with_paths(placed, ["part"]).select(
            F.col("part").alias("tree"), F.lit(0).cast("long").alias("block"), F.struct(
                "up.path", F.col("digest").alias("subroot"), "up.root").alias("up"))

    leaves = cut_lineage(ranked(leaves, "tree", ["id", "digest"]))
    rows = with_paths(leaves, ["id", "later"], forest)
    path = F.col("up.path")
    folded = F.aggregate(path, F.coalesce("later", "digest"), lambda node, step: F.sha2(
        F.concat(step["l"], node, step["r"]), 256))
    proof = F.array_join(F.transform(path, lambda step: F.concat(step["l"], step["r"])), "")
    return rows.select(
        F.col("id").alias(id_col), F.col("digest").alias("leaf"), "up.subroot", "up.root",
        F.sha2(proof, 256).alias("proof_sha256"), folded.alias("folded_root"), path.alias("path")).withColumn("verified", F.col("folded_root") == F.col("root"))
