"""Near duplicates by SimHash: an inverted index of byte positions with count filtering.

1. *Fingerprints.* A bit is set where more than half of the 64-bit hashes of a text's 3-word shingles,
   repeats included, have it. Documents of one fingerprint form a class at once; everything after
   works on one row per class, whose number is its fingerprint, so that no value is ever looked up.
2. *Postings.* Up to 3 differing bits touch at most 3 of the 8 bytes, so linked fingerprints share at
   least 5 positional bytes. A list per (position, byte) would hold a 256th of all documents. So a
   posting takes four positional bytes together: of the 14 blocks of the Steiner system S(3, 4, 8)
   one avoids any three positions, hence any two linked fingerprints meet in a list. Lists of 32-bit
   keys stay short, and lists of the same classes are kept once.
3. *Counts.* Members are held against one hub of their list: shared positional bytes are tallied, pairs
   below 5 dropped, the others verified bit by bit.
4. *The rest.* Lists that still hold more than one component are compared in blocks, each class outside
   the list's largest component against all others. No pairs are emitted but links between
   components; no list is capped.
5. *Components* by star contraction; names are the smallest ids.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.llm.graph import components
from riskframe.llm.linking import hub_pairs, open_blocks, shared_lists
from riskframe.operators.joins import spread_join
from riskframe.session import cut_lineage

WORDS = 3              # words of a shingle
SEED = 42
BITS = 3               # bits in which linked fingerprints may differ
BYTES = 8
MATCHES = BYTES - BITS   # positional bytes a linked pair shares at least
BLOCK_CLASSES = 20_000   # classes of a block where lists are compared in full
SLICE = 65_536           # shingles hashed at once
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def steiner_blocks() -> list[tuple[int, ...]]:
    """The 14 blocks of four of eight positions that hold each three positions once: those whose
    numbers cancel out bit by bit. With a block its complement is one too."""
    return [c for c in combinations(range(BYTES), 4) if c[0] ^ c[1] ^ c[2] ^ c[3] == 0]


def fingerprint(text: bytes) -> int:
    """The fingerprint of a UTF-8 text; 0 without words."""
    words = text.translate(LOWER).split()
    if not words:
        return 0
    joined, last = b" ".join(words), min(WORDS, len(words)) - 1
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts, ends = (ends - lengths)[:len(words) - last], ends[last:]
    digest, ones = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, len(starts), SLICE):
        spans = zip(starts[at:at + SLICE].tolist(), ends[at:at + SLICE].tolist(), strict=True)
        hashes = np.array([digest(joined[a:b], SEED) for a, b in spans], ">u8")
        ones += np.unpackbits(hashes.view(np.uint8)).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(starts)).tobytes(), "big")


def fingerprinted(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id and node (the fingerprint as a signed number) of each row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            found = np.array([fingerprint(text.as_py() or b"") for text in texts], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found.view(np.int64))], ["id", "node"])
    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(run, f"id {kind}, node long")


def byte_at(value: Column, position: int) -> Column:
    return F.shiftrightunsigned(value, 8 * position).bitwiseAND(F.lit(255).cast("long"))


def posting_lists(classes: DataFrame) -> DataFrame:
    """list, node, mass, hub: the classes that share four positional bytes, two or more."""
    keys = []
    for number, block in enumerate(steiner_blocks()):
        key = F.lit(number).cast("long")
        for position in block:
            key = F.shiftleft(key, 8).bitwiseOR(byte_at(F.col("node"), position))
        keys.append(key)
    return shared_lists(classes.select(F.explode(F.array(*keys)).alias("key"), "node",
                                       F.lit(1).cast("long").alias("mass")))


def verified(pairs: DataFrame) -> DataFrame:
    """The (a, b) that share enough positional bytes and differ in few bits."""
    changed = F.col("a").bitwiseXOR(F.col("b"))
    shared = sum(((byte_at(changed, i) == 0).cast("int") for i in range(BYTES)), F.lit(0))
    return pairs.filter(shared >= MATCHES).filter(F.bit_count(changed) <= BITS)


def links_between(rows: pd.DataFrame) -> pd.DataFrame:
    """Links of a pair of blocks: of each outer row, one to each other component it is close to."""
    inner, outer = rows[~rows["outer"]], rows[rows["outer"]]
    nodes, comps = inner["node"].to_numpy(), inner["component"].to_numpy()
    links = []
    for node, comp in zip(outer["node"].to_numpy(), outer["component"].to_numpy(), strict=True):
        near = np.flatnonzero(np.bitwise_count((nodes ^ node).view(np.uint64)) <= BITS)
        near = near[comps[near] != comp]
        if len(near):
            firsts = np.unique(comps[near], return_index=True)[1]
            links += [(node, other) for other in nodes[near][firsts]]
    return pd.DataFrame(links, columns=["a", "b"], dtype="int64")


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, fingerprint (16 hex digits), component_id.

    Words are separated by ASCII white space and A-Z are lower-cased; a text below three words has
    them all as its only shingle. A null, empty or blank text has the fingerprint zero and is linked
    like any other. Rows of one id are documents each; component_id is the smallest id reachable, a
    null id is larger than any other. Extra columns are ignored. An empty table gives no rows.
    """
    rows = cut_lineage(fingerprinted(docs, id_col, text_col))
    classes = cut_lineage(rows.groupBy("node").agg(F.min("id").alias("least")))
    members = cut_lineage(posting_lists(classes.select("node")))
    links = cut_lineage(verified(hub_pairs(members)))
    found = components(links)
    rest = open_blocks(members, found, block_mass=BLOCK_CLASSES)
    more = cut_lineage(rest.groupBy("list", "o", "i").applyInPandas(links_between, "a long, b long").distinct())
    if not more.isEmpty():
        found = components(links.unionByName(more))
    linked = found.join(classes, "node")
    names = linked.groupBy("component").agg(F.min("least").alias("component_id"))
    named = cut_lineage(linked.join(names, "component").select("node", "component_id"))
    named = cut_lineage(classes.join(named, "node", "left").select(
        "node", F.coalesce("component_id", "least").alias("component_id")))
    # One fingerprint may be that of a third of all rows.
    out = spread_join(rows, named, ["node"])
    return out.select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("node"), 16, "0")).alias("fingerprint"),
        F.coalesce("component_id", "id").alias("component_id"))
