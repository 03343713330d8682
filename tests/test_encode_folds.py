"""Encodings, leak tests and fold rules."""
import collections

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from riskframe import config
from riskframe.operators import encode, folds

SCHEMA = "record_id int, split string, fold int, district string, flood_risk_score double"
ROWS = [(1, "train", 0, "Aa", 0.1), (2, "train", 1, "Aa", 0.3), (3, "train", 1, "zz", 0.5),
        (4, "train", 2, None, 0.7), (5, "train", 0, "bb", 0.9), (6, "test", None, "new", None),
        (7, "test", None, "zz", None), (8, "test", None, None, None)]


@pytest.fixture(scope="module")
def small(spark):
    return spark.createDataFrame(ROWS, SCHEMA).persist()


def direct(category, fold):
    seen = [r for r in ROWS if r[1] == "train" and r[2] != fold]
    mine = [r[4] for r in seen if r[3] == category and category is not None]
    pool = mine or [r[4] for r in seen]
    return sum(pool) / len(pool)


def test_per_fold_target_encoding_equals_direct_form(small):
    got = encode.add_fold_target_encoding(small, ["district"], 3).collect()
    for r in got:
        for f in range(3):
            assert r["district_te"][f] == pytest.approx(direct(r["district"], f))


def test_own_fold_targets_do_not_leak(spark, small):
    changed = small.withColumn("flood_risk_score", F.when(
        F.col("fold") == 1, 99.0).otherwise(F.col("flood_risk_score")))
    before = {r["record_id"]: r["district_te"][1] for r in
              encode.add_fold_target_encoding(small, ["district"], 3).collect()}
    after = {r["record_id"]: r["district_te"][1] for r in
             encode.add_fold_target_encoding(changed, ["district"], 3).collect()}
    assert before == after


def label_codes(fold, sentinel=True):
    seen = {r[3] or "nan" for r in ROWS if r[1] == "train" and r[2] != fold}
    order = sorted(seen | ({"__UNSEEN__"} if sentinel else set()))
    return {c: i for i, c in enumerate(order)}


def test_unseen_takes_the_sentinel_in_sorted_position(small):
    for r in encode.add_fold_label_codes(small, ["district"], 3).collect():
        for f in range(3):
            codes = label_codes(f)
            assert r["district_code"][f] == codes.get(r["district"] or "nan", codes["__UNSEEN__"])


def test_unseen_first(small):
    for r in encode.add_fold_label_codes(small, ["district"], 3, unseen="first").collect():
        for f in range(3):
            assert r["district_code"][f] == label_codes(f, False).get(r["district"] or "nan", 0)


def test_native_codes_leave_unseen_null(small):
    got = {r["record_id"]: r["district_code"] for r in
           encode.add_fold_native_codes(small, ["district"], 3).collect()}
    assert got[5][0] is None and got[4] == [None] * 3 and got[6] == [None] * 3
    assert got[7] == [1, None, 2]


def test_rank_by_range_equals_window(spark):
    vocab = spark.range(3000).select(
        F.concat(F.lit("c"), (F.col("id") % 2).cast("string")).alias("column"),
        F.md5(F.col("id").cast("string")).alias("category"))
    a = {(r["column"], r["category"]): r["code"] for r in encode.rank_categories(vocab).collect()}
    b = {(r["column"], r["category"]): r["code"] for r in
         encode.rank_by_range(vocab, ["column"]).collect()}
    assert a == b


def test_standardise_constant_column(spark):
    df = spark.createDataFrame([(2.0, 1.0), (2.0, 3.0)], "a double, b double")
    assert [tuple(r) for r in encode.standardise(df, ["a", "b"]).select("a_std", "b_std").collect()] \
        == [(0.0, -1.0), (0.0, 1.0)]


def test_shuffled_folds_cover_and_balance(all_sites):
    counts = [r["count"] for r in folds.kfold(all_sites).groupBy("fold").count().collect()]
    assert len(counts) == 5 and min(counts) > 0.7 * max(counts)


def greedy(sizes, k):
    loads, out = [0] * k, {}
    for g, n in sorted(sizes.items(), key=lambda kv: (-kv[1], kv[0])):
        f = loads.index(min(loads))
        out[g] = f
        loads[f] += n
    return out


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.integers(0, 12), min_size=30, max_size=80))
def test_group_folds_property(spark, labels):
    sizes = collections.Counter(f"g{v}" for v in labels)
    if len(sizes) < 3:
        return
    df = spark.createDataFrame([(i, f"g{v}") for i, v in enumerate(labels)], "i int, g string")
    got = {r["g"]: r["fold"] for r in folds.group_kfold(df, "g", 3).select("g", "fold").distinct().collect()}
    assert got == greedy(sizes, 3)


def test_too_few_groups(spark):
    df = spark.createDataFrame([("a",), ("b",)], "g string")
    with pytest.raises(ValueError):
        folds.group_kfold(df, "g", 5)


def test_many_equal_groups_follow_the_plain_rule(spark):
    df = spark.range(4000).select((F.col("id") % 300).cast("string").alias("g"))
    table = folds.assign_groups(folds.group_sizes(df, F.col("g")), 4)
    sizes = collections.Counter(str(i % 300) for i in range(4000))
    assert {r["group"]: r["fold"] for r in table.collect()} == greedy(sizes, 4)


def test_global_encoding_defaults(small):
    got = {r["record_id"]: r["district_te"] for r in
           encode.add_target_encoding(small, ["district"]).collect()}
    assert got[6] == got[8] == got[4] == pytest.approx(0.5) and got[1] == pytest.approx(0.2)


def test_drop_profiles_ignore_absent_columns(small):
    from riskframe.operators.columns import drop_profile
    assert drop_profile(small, "clean").columns == ["split", "fold", "district"]
    assert config.DROP_PROFILES["baseline"][0] == config.ID
