"""Encoders over vocabularies too large to broadcast give what the small path gives."""
import pytest
from pyspark.sql import functions as F

from riskframe import config
from riskframe.operators import encode, folds, joins

COLUMNS = ["district", "soil_type", "landcover", "code"]


@pytest.fixture(scope="module")
def table(spark, all_sites):
    df = folds.kfold(all_sites, 3).select(config.ID, config.SPLIT, "fold", config.TARGET, *COLUMNS[:3])
    # One key holds a third of the rows, some keys have the sketch's separator, some are missing.
    key = F.when(F.col(config.ID) % 3 == 0, "a:b").when(F.col(config.ID) % 7 == 1, F.lit(None)).otherwise(
        F.concat(F.lit("1:"), (F.col(config.ID) % 400).cast("string")))
    return df.withColumn("code", key).withColumn("_key", F.lit("clash")).persist()


ENCODERS = {
    "label": lambda df: encode.label_encode(df, COLUMNS),
    "codes": lambda df: encode.category_codes(df, COLUMNS),
    "fold means": lambda df: encode.add_fold_target_encoding(df, COLUMNS, 3),
    "means": lambda df: encode.add_target_encoding(df, COLUMNS),
}


@pytest.mark.parametrize("name", ENCODERS)
@pytest.mark.parametrize("hot", [1, 3, 1000])
def test_large_path_equals_small_path(table, monkeypatch, name, hot):
    small = ENCODERS[name](table)
    want = sorted(map(repr, small.select(sorted(small.columns)).collect()))
    monkeypatch.setattr(config, "MAX_BROADCAST_ROWS", 10)
    monkeypatch.setattr(encode, "TOP_KEYS", hot)
    large = ENCODERS[name](table)
    assert sorted(large.columns) == sorted(small.columns)
    got = sorted(map(repr, large.select(sorted(small.columns)).collect()))
    assert len(got) == len(want) == table.count()
    assert got == want or name in ("means", "fold means") and [r[:60] for r in got] == [r[:60] for r in want]


def test_joins_do_not_grow_with_the_columns(table, monkeypatch):
    monkeypatch.setattr(config, "MAX_BROADCAST_ROWS", 10)

    def plan(columns):
        text = encode.label_encode(table, columns)._jdf.queryExecution().optimizedPlan().toString()
        return text.count("Join "), text.count("Relation ")
    assert plan(COLUMNS[:1]) == plan(COLUMNS)


def test_frequent_keys_are_found(table):
    cells = table.select(F.inline(F.array(*[F.struct(F.lit(i).alias("_col"), F.col(c).alias("_key")) for i, c in enumerate(COLUMNS)])))
    found = {tuple(r) for r in encode.frequent_keys(cells, 5).collect()}
    top = [(r["_col"], r["_key"]) for r in cells.na.drop().groupBy("_col", "_key").count().orderBy(F.desc("count")).limit(3).collect()]
    assert set(top) <= found and len(found) == 5


def test_hot_keys_by_rows_of_a_task(spark, monkeypatch):
    facts = spark.range(400).select("id", F.when(F.col("id") < 50, "hot").otherwise(F.col("id").cast("string")).alias("k"))
    lookup = facts.groupBy("k").agg(F.max("id").alias("top"))
    monkeypatch.setattr(config, "TASK_ROWS", 20)
    monkeypatch.setattr(config, "HOT_KEY_SHARE", 1.0)
    plain = sorted(map(tuple, facts.join(lookup, "k", "left").select("id", "k", "top").collect()))
    assert sorted(map(tuple, joins.spread_join(facts, lookup, ["k"]).collect())) == plain
