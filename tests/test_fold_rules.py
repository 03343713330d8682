"""Group folds equal the plain greedy rule; entry rules of delimited files and scores."""
import heapq
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.functions.cleaning import clean_nan
from riskframe.operators import evaluation, folds, spatial
from riskframe.sources import delimited


def plain(sizes, k):
    loads, fold = [(0, f) for f in range(k)], {}
    for g, n in sorted(sizes.items(), key=lambda x: (-x[1], x[0])):
        load, f = loads[0]
        fold[g] = f
        heapq.heapreplace(loads, (load + n, f))
    return fold


@pytest.mark.parametrize("part", range(4))
def test_segments_equal_the_plain_rule(part):
    for seed in range(100):
        check_segments(random.Random(100 * part + seed))


def check_segments(rng):
    k = rng.randrange(1, 7)
    top = rng.choice([3, 20, 1000])
    sizes = {f"{i:04}": rng.choice([rng.randrange(1, top + 1), 1, top]) for i in range(rng.randrange(1, 120))}
    counts = {}
    for n in sizes.values():
        counts[n] = counts.get(n, 0) + 1
    segments = folds.greedy_segments(list(counts.items()), k)
    got, ranks = {}, {}
    for g, n in sorted(sizes.items()):
        r = ranks[n] = ranks.get(n, -1) + 1
        cycle, at = next((c, r - first) for s, first, m, c in segments if s == n and first <= r < first + m)
        got[g] = cycle[at % len(cycle)]
    assert got == plain(sizes, k)
    assert len(segments) <= k * len(counts)


def test_group_folds_of_many_groups(spark):
    rng = random.Random(1)
    rows = [(f"g{rng.randrange(300)}" if rng.random() < 0.9 else "hot",) for _ in range(3000)]
    df = spark.createDataFrame(rows, "g string")
    sizes = {}
    for g, in rows:
        sizes[g] = sizes.get(g, 0) + 1
    got = {r["g"]: r["fold"] for r in folds.group_kfold(df, "g").distinct().collect()}
    assert got == plain(sizes, 5)


def test_csv_by_header(spark, tmp_path):
    path = str(tmp_path / "a.csv")
    (tmp_path / "a.csv").write_text('more,name,id\n1,"a ""b"", c\nd",7\n2, NA ,8\n3,NA,x\n')
    kinds = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType())])
    assert [tuple(r) for r in delimited.read_csv(spark, path, kinds).collect()] == [
        (7, 'a "b", c\nd'), (8, " NA "), (None, None)]
    with pytest.raises(ValueError, match="no column other"):
        delimited.read_csv(spark, path, T.StructType([T.StructField("other", T.LongType())]))


def test_pair_takes_the_wider_type(spark, tmp_path):
    (tmp_path / "train.csv").write_text("record_id,x,flood_risk_score\n1,2,0.5\n")
    (tmp_path / "test.csv").write_text("x,record_id\nunknown,2\n")
    pair = delimited.load_pair(spark, str(tmp_path / "train.csv"), str(tmp_path / "test.csv"))
    assert dict(pair.dtypes)["x"] == "string"
    assert {(r["record_id"], r["x"], r["split"]) for r in pair.collect()} == {(1, "2", "train"), (2, "unknown", "test")}


def test_nan_is_missing_after_entry(spark):
    df = spark.createDataFrame([(float("nan"), 1), (2.0, 2)], "x double, n long")
    assert [r["x"] for r in clean_nan(df).orderBy("n").collect()] == [None, 2.0]


def test_rows_without_fold_count_in_the_total_only(spark):
    df = spark.createDataFrame([(0, 1.0, 1.0), (1, 1.0, 0.0), (None, 0.0, 1.0)], "fold int, flood_risk_score double, m double")
    got = {r["fold"]: r["mae"] for r in evaluation.metrics_by_fold(df, ["m"]).collect()}
    assert got == {0: 0.0, 1: 1.0, None: pytest.approx(2 / 3)}


def test_many_centres_equal_few(spark):
    rng = random.Random(2)
    centres = [(f"c{i:04}", rng.randrange(50) / 1.0, rng.randrange(50) / 1.0) for i in range(400)]
    points = [(i, rng.random() * 50, rng.random() * 50 if i else None) for i in range(60)]
    df = spark.createDataFrame(points, "i int, latitude double, longitude double")
    got = {r["i"]: r["centroid"] for r in spatial.nearest_centroid(df, ["latitude", "longitude"], centres).collect()}
    assert got == {i: None if y is None else min(((x - a) ** 2 + (y - b) ** 2, n) for n, a, b in centres)[1]
                   for i, x, y in points}


def test_fold_views_from_one_scan(spark):
    df = spark.createDataFrame([(0, 1.0), (0, 2.0), (1, 4.0), (None, 8.0)], "fold int, flood_risk_score double")
    got = {(r["fold"], r["side"]): (r["rows"], r["value_sum"]) for r in folds.fold_sizes(df).collect()}
    for f in (0, 1):
        for side, view in (("train", folds.training_view), ("valid", folds.validation_view)):
            rows = view(df, f).agg(F.count("*"), F.sum("flood_risk_score")).first()
            assert got[f, side] == tuple(rows)
