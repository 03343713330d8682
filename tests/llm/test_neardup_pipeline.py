"""Near duplicates against all pairs, components, the pipeline and the SQL twins."""
import os
import random

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from riskframe.llm import graph, linking, neardup, quality
from riskframe.llm.oracles import ORACLES
from riskframe.llm.queries import QUERIES


def shingles(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = low.encode().split()
    return frozenset(zip(words, words[1:])) if len(words) > 1 else frozenset(words)


def classes(rows):
    """Smallest id of each row's component, over all pairs."""
    sets = [shingles(t) for _, t in rows]
    names = list(range(len(rows)))

    def top(x):
        while names[x] != x:
            x = names[x]
        return x
    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= 80 * len(a | sets[j]):
                names[top(i)] = top(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[top(i)] = min(least.get(top(i), doc), doc)
    return [(doc, len(sets[i]), least.get(top(i), doc), doc == least.get(top(i), doc)) for i, (doc, _) in enumerate(rows)]


def corpus(seed, groups, copies, edits):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    rows = []
    for _ in range(groups):
        base = [rng.choice(words) for _ in range(rng.randrange(2, 120))]
        for _ in range(copies):
            text = list(base)
            for _ in range(rng.randrange(edits + 1)):
                text[rng.randrange(len(text))] = rng.choice(words)
            rows.append((len(rows), " ".join(text)))
    return rows


@pytest.mark.parametrize("mass", [500_000, 300])
def test_equals_all_pairs(spark, mass, monkeypatch):
    monkeypatch.setattr(linking, "BLOCK_MASS", mass)
    rows = corpus(1, 40, 4, 6) + [(i + 1000, t) for i, t in corpus(2, 1, 120, 9)]
    rows += [(2000, None), (2001, ""), (2002, " \t"), (2003, "One"), (2004, "one\n"), (2005, "a\x85b c"), (2006, "A\x85B C"),
             (2007, "x y " * 20_000), (2003, "One"), (None, "one"), (None, "alone here")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, n long")
    got = sorted(map(tuple, neardup.near_duplicates(df).collect()), key=str)
    assert got == sorted(classes(rows), key=str)
    kept = neardup.keep_one(df)
    assert kept.columns == df.columns
    assert sorted(r["doc_id"] for r in kept.filter("doc_id IS NOT NULL").collect()) == sorted(
        doc for doc, _, _, keep in classes(rows) if keep and doc is not None)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert neardup.near_duplicates(df).count() == 0 and neardup.keep_one(df).count() == 0


def test_components_of_paths_and_stars(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(100, 180)] + [(5, i) for i in range(10, 60)] + [(7, 7), (1, 2), (2, 1), (1, 2)]
    rng.shuffle(edges)
    got = {r["node"]: r["component"] for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 100 for i in range(100, 181)}, 5: 5, **{i: 5 for i in range(10, 60)}, 1: 1, 2: 1}


def test_stages(spark, data_dir):
    docs = spark.read.parquet(f"{data_dir}/documents.parquet")
    more = spark.createDataFrame([(-1, None, None, None, None), (-2, "", "en", "src0", 0)], docs.schema)
    docs = first = docs.unionByName(more)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r["doc_id"] for r in docs.select("doc_id").collect()}
        docs = stage(spark, docs, data_dir).cache()
        assert docs.columns == first.columns, name
        assert {r["doc_id"] for r in docs.select("doc_id").collect()} <= before
        assert docs.filter("n_chars <> length(text)").count() == 0
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, data_dir)
    assert packed.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, first.limit(0), data_dir).count() == 0


def test_run_holds_to_its_stages(spark, data_dir):
    rows = corpus_pipeline.run(spark, data_dir)
    docs = spark.read.parquet(f"{data_dir}/documents.parquet")
    good = QUERIES["op2_quality_rules"](spark, data_dir).filter("kept").select("doc_id")
    assert rows.join(good, "doc_id", "left_anti").count() == 0
    # A clean document that shares no line and no near copy stays.
    alone = QUERIES["op4_line_dedup"](spark, data_dir).filter("n_dropped = 0").join(
        QUERIES["op9_near_duplicates"](spark, data_dir).filter("kept"), "doc_id").join(good, "doc_id")
    assert alone.join(rows, "doc_id", "left_anti").count() == 0
    assert rows.select("doc_id").distinct().count() <= docs.count()


TABLES = ["documents", "pages", "labels", "conversations", "benchmark", "embeddings"]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_twin(spark, data_dir, name):
    con = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{data_dir}/{t}.parquet"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{data_dir}/{t}.parquet'")
    theirs = con.execute(ORACLES[name])
    names = [d[0] for d in theirs.description]
    ours = QUERIES[name](spark, data_dir)
    assert sorted(names) == sorted(ours.columns)
    assert sorted(map(repr, map(tuple, ours.select(names).collect()))) == sorted(map(repr, theirs.fetchall()))


def test_quality_stage_takes_all_trusted_documents(spark, tmp_path, monkeypatch):
    n, seen = 10_200, []
    docs = spark.range(n).select(F.col("id").alias("doc_id"), F.lit("some words of a text").alias("text"))
    docs.select("doc_id", F.lit(1).alias("quality"), F.lit(0).alias("toxic")).write.parquet(f"{tmp_path}/labels.parquet")
    fit = quality.fit_weights

    def noted(texts):
        seen.append(texts.filter("held_out IS NOT NULL").count())
        return fit(texts)
    monkeypatch.setattr(quality, "fit_weights", noted)
    assert corpus_pipeline.quality(spark, docs, str(tmp_path)).columns == docs.columns
    assert seen == [n]


def test_quality_stage_sets_its_threshold_by_all_trusted_documents(spark, tmp_path, monkeypatch):
    seen, quantiles = [], quality.quantile_values
    docs = spark.range(300).select(F.col("id").alias("doc_id"), F.lit("some words " * 12).alias("text"))
    docs.select("doc_id", F.lit(1).alias("quality"), F.lit(0).alias("toxic")).write.parquet(f"{tmp_path}/labels.parquet")

    def noted(scores, *rest):
        seen.append(scores.count())
        return quantiles(scores, *rest)
    monkeypatch.setattr(quality, "quantile_values", noted)
    assert corpus_pipeline.quality(spark, docs, str(tmp_path)).columns == docs.columns
    assert seen == [300]
