"""The Merkle manifest against a tree built in plain Python."""
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from riskframe.llm import merkle


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, text):
    values = (row["doc_id"], row["source"], row["lang"], row["n_chars"], text)
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(digests):
    """(root, for each leaf what stands before and after it on each level)."""
    paths, place, level = [[] for _ in digests], list(range(len(digests))), list(digests)
    while len(level) > 1:
        for i, path in enumerate(paths):
            run = place[i] // 8 * 8
            path.append(("".join(level[run:place[i]]), "".join(level[place[i] + 1:run + 8])))
            place[i] //= 8
        level = [digest("".join(level[run:run + 8])) for run in range(0, len(level), 8)]
    return level[0], paths


def plain(rows, later):
    parts = {}
    for row in rows:
        parts.setdefault(row["lang"], []).append((
            row["doc_id"] is not None, row["doc_id"] or 0, leaf(row, row["text"]), leaf(row, later(row))))
    names = sorted(parts, key=lambda x: (x is not None, (x or "").encode()))
    trees = {name: tree([d for _, _, d, _ in sorted(parts[name])]) for name in names}
    root, tops = tree([trees[name][0] for name in names])
    out = []
    for name, top in zip(names, tops, strict=True):
        subroot, paths = trees[name]
        for (given, number, d, found), path in zip(sorted(parts[name]), paths, strict=True):
            for before, after in path + top:
                found = digest(before + found + after)
            proof = digest("".join(a + b for a, b in path + top))
            out.append((number if given else None, d, subroot, root, proof, found, found == root))
    return sorted(out, key=str)


def corpus(sizes, seed=1):
    rng = random.Random(seed)
    rows = []
    for name, size in sizes.items():
        for _ in range(size):
            text = "".join(rng.choice("aBé😀 \n") for _ in range(rng.randrange(9)))
            rows.append((len(rows) * 7 % 100_003, rng.choice(["s", None, ""]), name, len(text), text))
    rng.shuffle(rows)
    return rows


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


@pytest.mark.parametrize("sizes", [
    {"en": 1}, {"en": 8}, {"en": 9, None: 1}, {"en": 4097, "fr": 1, "é": 64, None: 65, "": 2},
    {f"l{i}": 1 + i % 3 for i in range(70)}])
def test_equals_plain_tree(spark, sizes):
    rows = corpus(sizes)
    df = spark.createDataFrame([(*r, 5) for r in rows], SCHEMA + ", rank long").withColumn("tree", F.lit("x"))
    found = {"text": F.when(F.col("doc_id") % 3 == 0, F.upper("text")).otherwise(F.col("text"))}
    got = merkle.manifest(df, found=found).drop("path")
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    want = plain(df.collect(), lambda r: r["text"].upper() if r["doc_id"] % 3 == 0 else r["text"])
    assert sorted(map(tuple, got.collect()), key=str) == want


def test_many_levels_and_chunks(spark, monkeypatch):
    monkeypatch.setattr(merkle, "BLOCK_LEVELS", 1)
    df = spark.createDataFrame(corpus({"en": 700, "de": 3}), SCHEMA)
    got = merkle.manifest(df).drop("path").collect()
    assert sorted(map(tuple, got), key=str) == plain(df.collect(), lambda r: r["text"])
    assert all(r["verified"] for r in got)


def test_nulls_ties_repeats_and_long_texts(spark):
    rows = [(None, None, None, None, None), (None, None, None, None, ""), (3, "s", None, 0, None),
            (3, "s", None, 0, ""), (3, "s", None, 0, ""), (4, "s", "en", 1, "Ab " * 300_000)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = sorted(map(tuple, merkle.manifest(df).drop("path").collect()), key=str)
    assert got == plain(df.collect(), lambda r: r["text"])


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert merkle.manifest(empty).count() == 0


def test_a_change_of_any_column_shows(spark):
    df = spark.createDataFrame(corpus({"en": 30, "de": 30}), SCHEMA)
    for name, value in (("source", F.lit("other")), ("n_chars", F.col("n_chars") + 1), ("text", F.lit(None))):
        found = merkle.manifest(df, found={name: F.when(F.col("doc_id") == 7, value).otherwise(F.col(name))})
        assert [r["doc_id"] for r in found.filter("NOT verified").collect()] == [7]


def test_no_join_of_leaves_in_the_proofs(spark):
    df = spark.createDataFrame(corpus({"en": 50}), SCHEMA)
    plan = merkle.manifest(df)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Python" not in plan and "Arrow" not in plan
