"""Repeated and nearly repeated lines: a segment-partition edit join.

A line of the corpus stays where it stands first; later lines within `THRESHOLD` edits of it, or
joined to it by a chain of such lines, go.

1. *Exact.* Lines are known by 128-bit hashes; equal lines are counted and their first place found
   by an aggregation that combines before the shuffle.
2. *Segments.* A line is cut into `THRESHOLD + 1` segments. Two lines within the threshold share a
   segment of the one in a nearby place of the other. A line is indexed under the hash of (length,
   segment number, segment) and probes, for each length up to `THRESHOLD` shorter, the substrings
   whose place can still match. Only hashes are shuffled, and those of one line alone vanish.
3. *Lists.* Lines of one hash are held against a hub, and lists in several components are then
   compared in full in blocks (see `linking`). A line in a million variants costs its rows.
4. *Verification* by an edit distance that keeps one bit per diagonal of the band.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.graph import components
from riskframe.llm.linking import hub_pairs, open_blocks, shared_lists
from riskframe.llm.text import filled, lines_of
from riskframe.session import cut_lineage

THRESHOLD = 2             # edits between lines that count as the same
MIN_CHARS = 1             # shorter lines are left alone: blank ones
MIN_NEAR_CHARS = 20       # shorter lines only repeat exactly
MAX_BROADCAST_IDS = 1_000_000
BLANK = " \t\n\x0b\f\r"


def segment_places(length: int, parts: int) -> list[tuple[int, int]]:
    """(start, size) of the segments of a line; the later ones take the rest."""
    base, longer = divmod(length, parts)
    places, at = [], 0
    for i in range(parts):
        size = base + (i >= parts - longer)
        places.append((at, size))
        at += size
    return places


def probe_places(length: int, shorter: int, threshold: int) -> list[tuple[int, int, int]]:
    """(segment, start, size) of the substrings of a line of `length` that can equal a segment of
    a line of `shorter` characters within the threshold.

    Seen from the left, the first i segments take at least i errors, or an earlier segment would
    match; seen from the right, so do the last ones. Both bound how far the place can be off.
    """
    gap, parts = length - shorter, threshold + 1
    found = []
    for i, (start, size) in enumerate(segment_places(shorter, parts)):
        low = max(start - i, start + gap - (threshold - i), 0)
        high = min(start + i, start + gap + (threshold - i), length - size)
        found += [(i, at, size) for at in range(low, high + 1)]
    return found


class Places(dict):
    """Per length: the segments a line is posted and looked up under, as (length, segment, start,
    end in bytes of UTF-32); worked out once per length."""

    def __init__(self, threshold: int):
        super().__init__()
        self.threshold = threshold

    def __missing__(self, length: int) -> list[tuple[bytes, int, int]]:
        found = {(length, i, at, size) for i, (at, size) in enumerate(
            segment_places(length, self.threshold + 1))}
        for shorter in range(max(length - self.threshold, 0), length + 1):
            found |= {(shorter, i, at, size) for i, at, size in probe_places(
                length, shorter, self.threshold)}
        value = self[length] = [
            (xxhash.xxh64_intdigest(f"{n}:{i}"), 4 * at, 4 * (at + size))
            for n, i, at, size in sorted(found)]
        return value


def within(left: str, right: str, threshold: int = THRESHOLD) -> bool:
    """Whether the edit distance of two strings is at most `threshold`.

    Equal ends are cut off. Then each register holds the diagonals of the band that are reached
    with so many edits, one bit a diagonal, and all of them move on by one character at once.
    """
    if abs(len(left) - len(right)) > threshold:
        return False
    head = common_head(left, right)
    left, right = left[head:], right[head:]
    tail = common_head(left[::-1], right[::-1])
    left, right = left[:len(left) - tail], right[:len(right) - tail]
    if not left or not right:
        return max(len(left), len(right)) <= threshold
    band = (1 << (2 * threshold + 1)) - 1
    # Bit d of a register: `right` is used up to the place in `left` plus d - threshold.
    registers, bit = [], 1 << threshold
    for _ in range(threshold + 1):
        registers.append(bit & band)
        bit |= bit << 1
    for at, char in enumerate(left):
        match = 0
        for d in range(2 * threshold + 1):
            place = at + d - threshold
            if 0 <= place < len(right) and right[place] == char:
                match |= 1 << d
        before = registers[0]
        registers[0] &= match
        for k in range(1, threshold + 1):
            now = registers[k]
            registers[k] = ((now & match) | before | (before >> 1)
                            | (registers[k - 1] << 1)) & band
            before = now
        if not registers[threshold]:
            return False
    return bool(registers[threshold] >> (len(right) - len(left) + threshold) & 1)


def common_head(left: str, right: str) -> int:
    """Length of the common prefix, by halving."""
    low, high = 0, min(len(left), len(right))
    while low < high:
        middle = (low + high + 1) // 2
        if left[low:middle] == right[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


def line_rows(docs: DataFrame, threshold: int, min_near: int, min_chars: int) -> DataFrame:
    """id, version, place, high, low, size, keys: a row per line of `min_chars` or more.

    Lines are taken without blanks around them. `docs` has id, version, text.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = Places(threshold)
        digest, hashed = xxhash.xxh3_128_intdigest, xxhash.xxh64_intdigest
        for batch in batches:
            rows, at, highs, lows, sizes, keys = [], [], [], [], [], []
            for row, text in enumerate(batch.column(2)):
                for place, line in enumerate((text.as_py() or "").split("\n")):
                    line = line.strip(BLANK)
                    size = len(line)
                    if size < min_chars:
                        continue
                    data = line.encode("utf-32-le", "surrogatepass")
                    whole = digest(data)
                    rows.append(row)
                    at.append(place)
                    highs.append((whole >> 64) - (1 << 63))
                    lows.append((whole & 0xFFFFFFFFFFFFFFFF) - (1 << 63))
                    sizes.append(size)
                    keys.append([hashed(data[a:b], seed) - (1 << 63) for seed, a, b in places[size]]
                                if size >= min_near else [])
            taken = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(taken), batch.column(1).take(taken), pa.array(at, pa.int32()),
                 pa.array(highs, pa.int64()), pa.array(lows, pa.int64()), pa.array(sizes, pa.int32()),
                 pa.array(keys, pa.list_(pa.int64()))],
                ["id", "version", "place", "high", "low", "size", "keys"])
    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(run, f"id {kind}, version long, place int, high long, low long, "
                                "size int, keys array<bigint>")


def close_pairs(threshold: int):
    """A mapper that keeps the (a, b) whose lines are within the threshold."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in frames:
            near = [within(x, y, threshold) for x, y in zip(rows["ta"], rows["tb"], strict=True)]
            yield rows.loc[near, ["a", "b"]]
    return run


def links_between(threshold: int):
    """A function from a pair of blocks to links between components, one per outer row and
    component it is close to."""
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        inner, outer = rows[~rows["outer"]], rows[rows["outer"]]
        links = []
        others = list(zip(inner["node"], inner["component"], inner["line"], strict=True))
        for node, comp, line in zip(outer["node"], outer["component"], outer["line"], strict=True):
            done = {comp}
            for other, its, text in others:
                if its not in done and within(line, text, threshold):
                    done.add(its)
                    links.append((node, other))
        return pd.DataFrame(links, columns=["a", "b"], dtype="int64")
    return run


def duplicate_lines(docs: DataFrame, threshold: int = THRESHOLD,
                    min_near: int = MIN_NEAR_CHARS, min_chars: int = MIN_CHARS) -> DataFrame:
    """id, version, drop (sorted places of the lines that go) of the documents that lose lines.

    `docs` has id, version, text; equal (id, version) have the same text.
    """
    lines = cut_lineage(line_rows(docs, threshold, min_near, min_chars))
    classes = lines.groupBy("high", "low").agg(
        F.count(F.lit(1)).alias("copies"), F.min(F.struct("id", "version", "place")).alias("first"))
    near = cut_lineage(lines.filter(F.size("keys") > 0).select(
        F.col("high").alias("node"), F.col("size").cast("long").alias("mass"), F.explode("keys").alias("key")
    ).groupBy("key").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).filter("lo <> hi").select("key"))
    posted = lines.filter(F.size("keys") > 0).select(
        F.col("high").alias("node"), F.col("size").cast("long").alias("mass"), F.explode("keys").alias("key"))
    near = F.broadcast(near) if near.count() <= MAX_BROADCAST_IDS else near
    members = cut_lineage(shared_lists(cut_lineage(posted.join(near, "key").distinct())))

    nodes = members.select("node").distinct()
    first = lines.filter(F.size("keys") > 0).join(nodes, F.col("high") == F.col("node")).groupBy("node").agg(
        F.min(F.struct("id", "version", "place")).alias("first")).select("node", "first.*")
    first = cut_lineage(first.select("node", F.col("id").alias("of"), F.col("version").alias("at"), "place"))
    wanted = F.broadcast(first) if first.count() <= MAX_BROADCAST_IDS else first
    texts = docs.join(wanted, F.col("id").eqNullSafe(F.col("of")) & (F.col("version") == F.col("at")))
    texts = cut_lineage(texts.select("node", F.btrim(
        F.get(lines_of(filled(F.col("text"))), F.col("place")), F.lit(BLANK)).alias("line")
    ).dropDuplicates(["node"]))

    left = texts.select(F.col("node").alias("a"), F.col("line").alias("ta"))
    right = texts.select(F.col("node").alias("b"), F.col("line").alias("tb"))
    pairs = hub_pairs(members).join(left, "a").join(right, "b").filter(
        F.abs(F.length("ta") - F.length("tb")) <= threshold)
    links = cut_lineage(pairs.mapInPandas(close_pairs(threshold), "a long, b long"))
    found = components(links)
    more = cut_lineage(open_blocks(members, found).join(texts, "node").groupBy(
        "list", "o", "i").applyInPandas(links_between(threshold), "a long, b long").distinct())
    if not more.isEmpty():
        found = components(links.unionByName(more))

    # Where each line of several places or variants stands first.
    firsts = cut_lineage(classes.join(found, F.col("high") == F.col("node"), "left").filter(
        "copies > 1 OR component IS NOT NULL").select("high", "low", "first", "component"))
    linked = firsts.filter("component IS NOT NULL").groupBy("component").agg(
        F.min("first").alias("earliest"))
    firsts = firsts.join(linked, "component", "left").select(
        "high", "low", F.coalesce("earliest", "first").alias("keep"))
    gone = lines.select("id", "version", "place", "high", "low").join(firsts, ["high", "low"]).filter(
        ~F.struct("id", "version", "place").eqNullSafe(F.col("keep")))
    return gone.groupBy("id", "version").agg(F.sort_array(F.collect_set("place")).alias("drop"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                threshold: int = THRESHOLD, min_near: int = MIN_NEAR_CHARS,
                min_chars: int = MIN_CHARS) -> DataFrame:
    """The table with the repeated lines taken out of its texts, and __n_lines, __n_dropped.

    First means the smallest id (null before all), then the smallest place. Lines are compared
    without ASCII blanks around them; below `min_chars` characters they always stay, and
    below `min_near` only exact repeats go. A null text
    stays null. Rows of one id and one text count as one document, so that all keep the same
    lines; of one id and different texts, the order is that of a hash of the text. No document
    goes, though it may end empty. Other columns are kept. An empty table stays empty.
    """
    version = F.xxhash64(filled(F.col(text_col)))
    rows = docs.select(F.col(id_col).alias("id"), version.alias("version"), F.col(text_col).alias("text"))
    drops = duplicate_lines(rows, threshold, min_near, min_chars).withColumnsRenamed(
        {"id": "__of", "version": "__at", "drop": "__drop"})
    drops = cut_lineage(drops)
    drops = F.broadcast(drops) if drops.count() <= MAX_BROADCAST_IDS else drops
    joined = docs.withColumn("__version", version).join(drops, F.col(id_col).eqNullSafe(F.col("__of")) & (
        F.col("__version") == F.col("__at")), "left")
    left = F.array_join(F.filter(lines_of(F.col(text_col)), lambda line, i: ~F.array_contains(
        F.col("__drop"), i)), "\n")
    count = F.coalesce(F.array_size(lines_of(F.col(text_col))), F.lit(0))
    return joined.select(
        *[c for c in docs.columns if c != text_col],
        F.when(F.col("__drop").isNull(), F.col(text_col)).otherwise(left).alias(text_col),
        count.cast("long").alias("__n_lines"),
        F.coalesce(F.array_size("__drop"), F.lit(0)).cast("long").alias("__n_dropped"))


