"""Lookups with hot and null keys, group statistics, exact quantiles beyond one buffer."""
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe import config
from riskframe.operators import groups, joins, quantiles


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share one key, a sixth have none."""
    return spark.range(6000).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 6 == 1, None)
        .otherwise(F.concat(F.lit("k"), (F.col("id") % 500).cast("string"))).alias("k"))


def test_spread_join_equals_plain_lookup(spark, skewed):
    lookup = skewed.filter("k is not null and k <> 'k5'").groupBy("k").agg(F.max("id").alias("top"))
    plain = skewed.join(lookup, "k", "left").select("id", "k", "top")
    spread = joins.spread_join(skewed, lookup, ["k"], 1 / 16).select("id", "k", "top")
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, spread.collect()))


def test_spread_join_spreads_the_hot_key(spark, skewed):
    lookup = skewed.filter("k is not null").groupBy("k").agg(F.max("id").alias("top"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = joins.spread_join(skewed, lookup, ["k"], 1 / 16).groupBy(
            F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert max(r["count"] for r in sizes) < 2500 and len(sizes) == 4


def test_large_lookup_is_not_broadcast(spark, skewed):
    lookup = skewed.filter("k is not null").groupBy("k").agg(F.max("id").alias("top"))
    small = joins.lookup_join(skewed, lookup, "k")
    large = joins.lookup_join(skewed, lookup, "k", max_rows=10)
    assert sorted(map(repr, small.select("id", "top").collect())) == sorted(
        map(repr, large.select("id", "top").collect()))


def test_lookup_default_for_missing_null_key_and_null_value(spark):
    facts = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, "z")], "id int, k string")
    lookup = spark.createDataFrame([("a", 1.0), ("b", None)], "k string, v double")
    got = joins.lookup_with_default(facts, lookup, "k", "v", 9.0, "out").collect()
    assert {r["id"]: r["out"] for r in got} == {1: 1.0, 2: 9.0, 3: 9.0, 4: 9.0}


def test_group_stats_fall_back_to_overall_values(spark):
    rows = [(1, "train", "one", 5.0), (2, "train", "two", 1.0), (3, "train", "two", 3.0),
            (4, "train", "void", None), (5, "train", None, 9.0), (6, "test", "new", 100.0)]
    df = spark.createDataFrame(rows, "record_id int, split string, district string, x double")
    got = {r["record_id"]: r for r in groups.add_group_stats(df, columns=["x"]).collect()}
    values = [5.0, 1.0, 3.0, 9.0]
    assert got[1]["district_x_mean"] == 5.0
    assert got[1]["district_x_std"] == pytest.approx(statistics.stdev(values))
    assert got[2]["district_x_std"] == pytest.approx(statistics.stdev([1.0, 3.0]))
    for i in (4, 5, 6):
        assert got[i]["district_x_mean"] == pytest.approx(4.5)
        assert got[i]["district_x_std"] == pytest.approx(statistics.stdev(values))


def test_quantiles_beyond_one_buffer(spark):
    df = spark.range(20000).select(
        F.when(F.col("id") % 7 == 0, None).otherwise((F.col("id") % 3).cast("string")).alias("g"),
        F.when(F.col("id") % 11 == 0, None).when(F.col("id") % 4 == 0, 1.5)
        .otherwise(F.sqrt((F.col("id") * 7919) % 100003)).alias("x"),
        (F.pow(F.lit(2.0), (F.col("id") % 64))).alias("y"))
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    pdf = df.toPandas()
    for accuracy in (10_000, 20):                  # tight and wide brackets
        narrow = quantiles.exact_quantiles(df, ["x", "y"], probs, buffered=100,
                                           accuracy=accuracy).collect()
        assert len(narrow) == 2
        for r in narrow:
            assert list(r["quantiles"]) == pytest.approx(
                list(np.nanquantile(pdf[r["column"]].astype(float), probs)), rel=1e-12)
    plain = {(r["g"], r["column"]): list(r["quantiles"]) for r in quantiles.exact_quantiles(
        df, ["x", "y"], probs, ["g"]).collect()}
    split = {(r["g"], r["column"]): list(r["quantiles"]) for r in quantiles.exact_quantiles(
        df, ["x", "y"], probs, ["g"], buffered=100, accuracy=20).collect()}
    assert len(plain) == 8 and plain.keys() == split.keys()
    for key, values in plain.items():
        assert split[key] == pytest.approx(values, rel=1e-12)


def test_group_transform_leaves_null_key_null(spark):
    df = spark.createDataFrame([(1, None, 1.0), (2, "a", 3.0), (3, "a", 5.0)],
                               "record_id int, district string, x double")
    got = {r["record_id"]: r["district_x_mean"] for r in groups.group_transform(
        df, "district", ["x"]).collect()}
    assert got == {1: None, 2: 4.0, 3: 4.0}


def test_lookup_plan_broadcasts_only_the_small_side(spark, all_sites):
    plan = groups.add_group_stats(all_sites, columns=config.GROUP_STAT_COLUMNS[:2])
    text = plan._jdf.queryExecution().toString()
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


def test_quantiles_of_an_empty_column(spark):
    df = spark.range(300).select(F.lit(None).cast("double").alias("x"), F.col("id").cast("double").alias("y"))
    for buffered in (1000, 100):
        got = quantiles.quantile_values(df, ["x", "y"], [0.5], buffered=buffered)
        assert got == {"x": [None], "y": [149.5]}
