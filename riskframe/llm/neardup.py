"""Near duplicates: MinHash signatures, joined by coordinate, links confirmed on full sets.

1. *Signatures.* A document's set holds its distinct 2-word shingles. Documents of equal sets form
   a class at once; everything after works on one row per class.
2. *Postings.* A class is posted under each of its (coordinate, value) pairs that another class
   has too. Two classes that agree in at least `MATCHES` of `COORDINATES` places share one of the
   `COORDINATES - MATCHES + 1` rarest pairs of either, so the others are skipped. Pairs are ranked
   by their exact frequency. Sets whose sizes forbid the similarity never meet: a list holds two
   neighbouring size bands. Lists of the same classes are kept once.
3. *First links.* Every member of a list is held against one hub of it; hubs differ between lists.
   Coordinates are counted on the signatures, and pairs with enough compared on their full sets.
4. *The rest.* Lists that still hold more than one component are compared in blocks, each class
   outside the list's largest component against all others: first on signatures, then, of the
   classes that found a partner, on sets. No pairs are emitted but links between components. So no
   list is capped, and a group of copies costs its size, not its square, unless its members really
   differ. Sets are worked out only for classes that signatures cannot tell apart.
5. *Components* by star contraction; names are the smallest ids.

A pair of similarity exactly 0.8 agrees in fewer than 36 of 64 places with odds of about 2 in a
million; what is confirmed is confirmed on the sets. Shingles are compared as 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.llm.graph import components
from riskframe.llm.linking import distinct_lists, hub_pairs, open_blocks, shared_lists
from riskframe.session import cut_lineage

COORDINATES = 64
MATCHES = 36              # coordinates a pair must agree in to be confirmed
PERCENT = 80              # 100 * intersection >= PERCENT * union
MAX_BROADCAST_IDS = 1_000_000
WORD_CACHE = 400_000      # hashes of words a task remembers

MIX_A, MIX_B, MIX_C = (np.uint64(x) for x in (
    0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xBF58476D1CE4E5B9))
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def coordinate_factors(count: int = COORDINATES) -> tuple[np.ndarray, np.ndarray]:
    """Odd factors and offsets of the hash functions, from their numbers."""
    def draw(kind: str) -> np.ndarray:
        return np.array([xxhash.xxh64_intdigest(f"{kind}{i}") for i in range(count)], np.uint64)
    return draw("factor") | np.uint64(1), draw("offset")


class WordHashes(dict):
    """Hash of a word, remembered; a full memory is emptied."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORD_CACHE:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def shingle_set(text: str | None, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct hashes of the 2-word shingles; of the only word if there is one."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(LOWER).split()
    codes = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    if len(codes) < 2:
        return codes
    left, right = codes[:-1] * MIX_A, codes[1:]
    mixed = left ^ (((right << np.uint64(31)) | (right >> np.uint64(33))) * MIX_B)
    return np.unique((mixed ^ (mixed >> np.uint64(29))) * MIX_C)


def signature(shingles: np.ndarray, factors: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Minimum of each hash function over the set."""
    least = np.full(len(factors), np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(shingles), 1024):
        part = np.multiply.outer(shingles[start:start + 1024], factors)
        part += offsets
        np.minimum(least, part.min(axis=0), out=least)
    return least


def lists_of(arrays: list[np.ndarray | None]) -> pa.Array:
    """An arrow column of bigint lists; None stays null."""
    sizes = [0 if x is None else len(x) for x in arrays]
    offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32),
                       mask=np.array([x is None for x in arrays] + [False]))
    full = [x for x in arrays if x is not None and len(x)]
    flat = np.concatenate(full).view(np.int64) if full else np.array([], np.int64)
    return pa.ListArray.from_arrays(offsets, pa.array(flat))


def signed(docs: DataFrame) -> DataFrame:
    """id, version, n, digest and signature of each row of (id, version, text); the last two null
    without words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factors, offsets = coordinate_factors()
        hashes = WordHashes()
        for batch in batches:
            sizes, digests, signatures = [], [], []
            for text in batch.column(2):
                found = shingle_set(text.as_py(), hashes)
                sizes.append(len(found))
                digests.append(xxhash.xxh3_128_digest(found.tobytes()) if len(found) else None)
                signatures.append(signature(found, factors, offsets) if len(found) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()),
                 pa.array(digests, pa.binary()), lists_of(signatures)],
                ["id", "version", "n", "digest", "sig"])
    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(run, f"id {kind}, version long, n long, digest binary, sig array<bigint>")


def sets_of(base: DataFrame, nodes: DataFrame) -> DataFrame:
    """node and shingles (its full set) of `nodes` (node, digest, key: id of one of its rows)."""
    few = nodes.count() <= MAX_BROADCAST_IDS
    texts = base.join(F.broadcast(nodes) if few else nodes, F.col("id").eqNullSafe(F.col("key")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            found = [shingle_set(text.as_py(), hashes) for text in batch.column(2)]
            # Another text may have the same id.
            right = pa.array([xxhash.xxh3_128_digest(x.tobytes()) == digest.as_py()
                              for x, digest in zip(found, batch.column(1), strict=True)])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), lists_of(found)], ["node", "shingles"]).filter(right)
    return cut_lineage(texts.select("node", "digest", "text").mapInArrow(
        run, "node long, shingles array<bigint>"))


def band_of(n: Column) -> Column:
    """Number of the size band; sizes a link allows lie in the same or neighbouring bands."""
    return F.floor(F.log(n.cast("double")) / F.log(F.lit(1.26))).cast("int")


def posting_lists(classes: DataFrame) -> DataFrame:
    """list, node, mass, hub: the members of each list of two classes or more."""
    keys = classes.select("node", "n", F.explode("sig").alias("key"))
    shared = keys.groupBy("key").agg(F.count(F.lit(1)).alias("f")).filter("f > 1")
    ranked = keys.join(shared, "key").groupBy("node", "n").agg(
        F.sort_array(F.collect_list(F.struct("f", "key"))).alias("keys"))   # at most one a coordinate
    # Pairs nobody else has are the rarest: they fill the prefix first.
    prefix = COORDINATES - MATCHES + 1 - (COORDINATES - F.size("keys"))
    posted = ranked.select("node", "n", F.explode(F.slice("keys", 1, F.greatest(
        prefix, F.lit(0)))).alias("k")).select("node", "n", F.col("k.key").alias("key"))
    bands = F.explode(F.array(band_of(F.col("n")), band_of(F.col("n")) + 1))
    posted = posted.select("node", "n", "key", bands.alias("band"))
    return shared_lists(cut_lineage(posted.select(
        F.xxhash64("key", "band").alias("key"), "node", F.col("n").alias("mass"))))


def with_both(pairs: DataFrame, values: DataFrame, name: str) -> DataFrame:
    """(a, b) with the column of `values` (node, ...) of both nodes as left and right."""
    return pairs.join(values.select(F.col("node").alias("a"), F.col(name).alias("left")), "a").join(
        values.select(F.col("node").alias("b"), F.col(name).alias("right")), "b")


def agreeing(pairs: DataFrame, signatures: DataFrame) -> DataFrame:
    """The (a, b) that agree in `MATCHES` coordinates or more."""
    same = F.filter(F.zip_with("left", "right", lambda x, y: x == y), lambda equal: equal)
    return with_both(pairs, signatures, "sig").filter(F.size(same) >= MATCHES).select("a", "b")


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The (a, b) that are similar on their full sets."""
    both = F.size(F.array_intersect("left", "right"))
    either = F.size("left") + F.size("right") - both
    return with_both(pairs, sets, "shingles").filter(both * 100 >= PERCENT * either).select("a", "b")


def agreeing_members(rows: pd.DataFrame) -> pd.DataFrame:
    """The nodes of a pair of blocks that agree with a node of another component across it."""
    inner, outer = rows[~rows["outer"]], rows[rows["outer"]]
    if not len(inner) or not len(outer):
        return pd.DataFrame({"list": [], "node": []}, dtype="int64")
    signatures = np.stack(inner["sig"].to_list())
    comps, hit, found = inner["component"].to_numpy(), np.zeros(len(inner), bool), []
    for node, comp, sig in zip(outer["node"], outer["component"], outer["sig"], strict=True):
        agree = ((signatures == sig).sum(axis=1) >= MATCHES) & (comps != comp)
        if agree.any():
            hit |= agree
            found.append(node)
    nodes = np.unique(np.concatenate([inner["node"].to_numpy()[hit], np.array(found, np.int64)]))
    return pd.DataFrame({"list": rows["list"].iloc[0], "node": nodes})


def links_between(rows: pd.DataFrame) -> pd.DataFrame:
    """Links of a pair of blocks: of each outer row, one to each other component it is similar to."""
    inner, outer = rows[~rows["outer"]], rows[rows["outer"]]
    links = []
    if len(inner) and len(outer):
        sizes = inner["shingles"].map(len).to_numpy()
        values = np.concatenate(inner["shingles"].to_list())
        owners = np.repeat(np.arange(len(inner)), sizes)
        order = np.argsort(values, kind="stable")
        values, owners = values[order], owners[order]
        nodes, comps = inner["node"].to_numpy(), inner["component"].to_numpy()
        for node, comp, mine in zip(outer["node"], outer["component"], outer["shingles"], strict=True):
            low = np.searchsorted(values, mine, "left")
            many = np.searchsorted(values, mine, "right") - low
            hits = np.repeat(low - np.cumsum(many) + many, many) + np.arange(many.sum())
            both = np.bincount(owners[hits], minlength=len(inner))
            near = (comps != comp) & (both * 100 >= PERCENT * (sizes + len(mine) - both))
            firsts = np.unique(comps[near], return_index=True)[1]
            links += [(node, other) for other in nodes[near][firsts]]
    return pd.DataFrame(links, columns=["a", "b"], dtype="int64")


def remaining_links(base: DataFrame, members: DataFrame, posted: DataFrame, found: DataFrame) -> DataFrame:
    """Links (a, b) between components that the lists still hold; all such pairs are compared."""
    rows = open_blocks(members, found).join(posted.select("node", "sig"), "node")
    close = rows.groupBy("list", "o", "i").applyInPandas(
        agreeing_members, "list long, node long").distinct()
    close = cut_lineage(close.join(posted.select("node", F.col("n").alias("mass")), "node"))
    close = cut_lineage(distinct_lists(close))
    nodes = cut_lineage(close.select("node").distinct().join(posted.drop("sig", "n"), "node"))
    rows = open_blocks(close, found, least=2).join(sets_of(base, nodes), "node")
    return rows.groupBy("list", "o", "i").applyInPandas(links_between, "a long, b long").distinct()


def linked_rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, version (hash of the text), n, component, kept of each row; see `near_duplicates`."""
    base = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("version"),
                       F.col(text_col).alias("text"))
    rows = cut_lineage(signed(base))
    classes = rows.filter("n > 0").groupBy("digest").agg(
        F.min("id").alias("id"), F.first("n").alias("n"), F.first("sig").alias("sig"))
    classes = cut_lineage(classes.withColumn("node", F.monotonically_increasing_id()))

    members = cut_lineage(posting_lists(classes))
    posted = cut_lineage(classes.join(members.select("node").distinct(), "node").select(
        "node", "n", "digest", F.col("id").alias("key"), "sig"))
    pairs = cut_lineage(agreeing(hub_pairs(members), posted))
    nodes = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    nodes = cut_lineage(posted.drop("sig", "n").join(nodes, "node"))
    links = cut_lineage(confirmed(pairs, sets_of(base, nodes)))
    found = components(links)
    more = cut_lineage(remaining_links(base, members, posted, found))
    if not more.isEmpty():
        found = components(links.unionByName(more))

    linked = found.join(classes.select("node", "id", "digest"), "node")
    names = linked.groupBy("component").agg(F.min("id").alias("component_id"))
    linked = linked.join(names, "component").select("digest", "component_id")
    alone = classes.select("digest", F.col("id").alias("class_id"))
    named = alone.join(linked, "digest", "left").select(
        "digest", F.coalesce("component_id", "class_id").alias("component_id"))
    out = rows.select("id", "version", "n", "digest").join(named, "digest", "left")
    component = F.coalesce("component_id", "id")
    return out.select("id", "version", "n", component.alias("component"),
                      component.eqNullSafe(F.col("id")).alias("kept"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_shingles, component_id, kept.

    Words are separated by ASCII white space and A-Z are lower-cased; a text of one word has that
    word as its only shingle. A null, empty or blank text has none and is linked with nothing.
    Rows of one id are documents each; equal sets are linked at any size. component_id is the
    smallest id reachable, kept whether it is the row's own; rows that repeat that id all stay, and
    a null id is larger than any other. Extra columns are ignored. An empty table gives no rows.
    """
    return linked_rows(docs, id_col, text_col).select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
        F.col("component").alias("component_id"), "kept")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of the table that `near_duplicates` keeps, all columns as they were."""
    rows = linked_rows(docs, id_col, text_col).filter("NOT kept").select(
        F.col("id").alias("__id"), F.col("version").alias("__version")).distinct()
    gone = cut_lineage(rows)
    small = F.broadcast(gone) if gone.count() <= MAX_BROADCAST_IDS else gone
    return docs.join(small, F.col(id_col).eqNullSafe(F.col("__id")) & (
        F.xxhash64(text_col) == F.col("__version")), "left_anti")
