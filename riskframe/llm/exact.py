"""Exact duplicates by an extendible-hash index on shared files, in DataFrame operations only.

1. *Insert.* Every row becomes (hash of the normalised text, length, digest) and the rows of equal
   bytes meet in one entry. The texts themselves are grouping keys, so bytes are compared and two
   texts of one hash become two entries of a chain. Copies are combined before the shuffle; a text
   that fills a third of the table costs one row per task.
2. *Directory.* Entries are counted by the leading bits of their hash. A bucket above `capacity`
   is split by its next bit until it fits, and the directory doubles whenever a bucket is deeper
   than it. Only counts of prefixes reach the driver, at most 2**`MAX_DEPTH` of them at any size
   of table; a bucket that is still overfull at that depth keeps a chain of pages.
3. *Owners.* The entries are written to shared files by bucket: each owner task has a contiguous
   range of hash prefixes and writes it sorted, so that the entries of a chain are neighbours.
4. *Probe.* Every row looks up its entry by hash, length and digest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.llm.text import filled, lower_ascii
from riskframe.session import scratch_path

MAX_DEPTH = 16        # leading bits the directory may use
BUCKET_CAPACITY = 1_000_000   # entries a bucket holds before it is split


def prefix_of(key: Column, depth: int) -> Column:
    """The `depth` leading bits of a 64-bit hash as a number."""
    return F.shiftrightunsigned(key, 64 - depth).cast("int") if depth else F.lit(0)


def build_directory(counts: dict[int, int], depth: int, capacity: int) -> list[tuple[int, int, int]]:
    """Buckets (first prefix, last prefix, local depth) covering all prefixes of `depth` bits.

    `counts` has the entries of each prefix. A bucket over `capacity` splits in two halves of its
    hash range until it fits or is one prefix wide.
    """
    sums = [0] * ((1 << depth) + 1)
    for prefix in range(1 << depth):
        sums[prefix + 1] = sums[prefix] + counts.get(prefix, 0)
    buckets, waiting = [], [(0, (1 << depth) - 1, 0)]
    while waiting:
        first, last, local = waiting.pop()
        if local < depth and sums[last + 1] - sums[first] > capacity:
            middle = (first + last) // 2
            waiting += [(middle + 1, last, local + 1), (first, middle, local + 1)]
        else:
            buckets.append((first, last, local))
    return buckets


def bucket_of(key: Column, buckets: list[tuple[int, int, int]]) -> Column:
    """The bucket that holds a hash: one look into the directory, which has a slot for each prefix
    of the depth of its deepest bucket."""
    depth = max(local for _, _, local in buckets)
    slots = []
    for number, (_, _, local) in enumerate(buckets):
        slots += [str(number)] * (1 << (depth - local))
    directory = F.split(F.lit(",".join(slots)), ",").cast("array<int>")
    return F.get(directory, prefix_of(key, depth))


def hash_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               capacity: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows, index): each row's key and the written index of distinct normalised texts.

    rows: id, key, size, text_sha256. index: key, size, text_sha256, keep_id, group_size,
    bucket. A null text counts as empty; an empty table gives an empty index.
    """
    spark, capacity = docs.sparkSession, capacity or BUCKET_CAPACITY
    norm = lower_ascii(filled(F.col(text_col)))
    rows = docs.select(F.col(id_col).alias("id"), norm.alias("norm")).select(
        "id", "norm", F.xxhash64("norm").alias("key"))
    entries = rows.groupBy("key", "norm").agg(
        F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    entries = entries.select(
        "key", F.octet_length("norm").alias("size"), F.sha2("norm", 256).alias("text_sha256"),
        "keep_id", "group_size")
    raw = scratch_path(spark, "entries")
    entries.write.parquet(raw)
    entries = spark.read.schema(entries.schema).parquet(raw)

    counts = {r["p"]: r["n"] for r in entries.groupBy(
        prefix_of(F.col("key"), MAX_DEPTH).alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()}
    buckets = build_directory(counts, MAX_DEPTH, capacity)
    path = scratch_path(spark, "index")
    owned = entries.withColumn("bucket", bucket_of(F.col("key"), buckets))
    owned = owned.repartitionByRange("bucket", "key").sortWithinPartitions(
        "bucket", "key", "size", "text_sha256")
    owned.write.parquet(path)
    index = spark.read.schema(owned.schema).parquet(path)
    return rows.select("id", "key", F.octet_length("norm").alias("size"),
                       F.sha2("norm", 256).alias("text_sha256")), index


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     capacity: int | None = None) -> DataFrame:
    """One row per document: id, keep_id, group_size, kept, text_sha256.

    Texts are equal when their bytes are after A-Z are lower-cased; of equal ones the largest id
    stays. Null texts are empty texts and equal to each other. Rows that repeat an id are members
    of their group like any other, and a row is kept when its id is the one that stays. A null id
    loses to any other; a group with no id at all keeps its rows. Extra columns are ignored. An
    empty table gives no rows.
    """
    rows, index = hash_index(docs, id_col, text_col, capacity)
    shared = index.filter("group_size > 1").drop("bucket")
    found = rows.join(shared, ["key", "size", "text_sha256"], "left")
    keep = F.coalesce("keep_id", "id")
    return found.select(
        F.col("id").alias(id_col), keep.alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        keep.eqNullSafe(F.col("id")).alias("kept"), "text_sha256")
