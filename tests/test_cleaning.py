"""Number coercion, missing tokens, flags and fills on hand-made cells."""
import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe import config
from riskframe.functions import cleaning, features
from riskframe.session import scratch_path
from riskframe.sources import delimited


def expected_number(text):
    if text is None:
        return None
    text = text.strip(" ")
    return float(text) if re.fullmatch(r"[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?", text) else None


def coerce(spark, cells):
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cells)], "i int, c string")
    return [r[0] for r in df.select("i", cleaning.to_number(F.col("c")).alias("v"))
            .orderBy("i").select("v").collect()]


def test_numbers_from_dirty_text(spark):
    cells = ["12.5", " 3 ", "7d", "1_0", "unknown", "inf", "nan", "", None, "-2e3", ".5", "5.", "+1"]
    assert coerce(spark, cells) == [12.5, 3.0, None, None, None, None, None, None, None,
                                    -2000.0, 0.5, 5.0, 1.0]


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text("0123456789.eE+-_ dfNa", max_size=8), min_size=20, max_size=60))
def test_numbers_property(spark, cells):
    assert coerce(spark, cells) == [expected_number(c) for c in cells]


def test_flags_come_before_fills(spark):
    df = spark.createDataFrame([("unknown", None), ("4", 2.0)], "nearest_evac_km string, ndvi double")
    out = cleaning.fill_constants(cleaning.add_missing_flags(cleaning.coerce_numeric(df)),
                                  {"nearest_evac_km": 10.0, "ndvi": 0.0}).collect()
    assert [r["nearest_evac_km"] for r in out] == [10.0, 4.0]
    assert [r["nearest_evac_km_missing"] for r in out] == [1, 0]
    assert [r["ndvi_missing"] for r in out] == [1, 0]


def test_zero_denominators_give_null(spark):
    df = spark.createDataFrame([(1.0, -1.0, -0.1, 2.0)],
                               "rainfall_7d_mm double, monthly_rainfall_mm double, "
                               "infrastructure_score double, nearest_evac_km double")
    row = df.select(
        features.INTERACTIONS["rain_ratio"][1]().alias("a"),
        F.try_divide(F.col("nearest_evac_km"), F.col("infrastructure_score") + 0.1).alias("b")).first()
    assert row["a"] is None and row["b"] is None


def test_clip_keeps_null(spark):
    df = spark.createDataFrame([(-1.0,), (0.4,), (7.0,), (None,)], "p double")
    assert [r[0] for r in df.select(features.clip_unit(F.col("p"))).collect()] == [0.0, 0.4, 1.0, None]


def test_csv_tokens_and_types(spark):
    path = scratch_path(spark, "tokens")
    cells = [("1", "NA", "2.5", "x"), ("2", "None", "NaN", "nan"), ("3", "", "7d", "y z")]
    spark.createDataFrame(cells, "record_id string, a string, b string, c string").write.csv(
        path, header=True)
    schema = T.StructType.fromDDL("record_id long, a double, b double, c string")
    got = {r["record_id"]: (r["a"], r["b"], r["c"]) for r in delimited.read_csv(spark, path, schema).collect()}
    assert got == {1: (None, 2.5, "x"), 2: (None, None, None), 3: (None, None, "y z")}
    kinds = {f.name: f.dataType.simpleString() for f in delimited.infer_schema(spark, path)}
    assert kinds == {"record_id": "bigint", "a": "double", "b": "string", "c": "string"}


def test_load_pair_marks_splits(spark):
    train, test = scratch_path(spark, "train"), scratch_path(spark, "test")
    spark.createDataFrame([(1, 0.5)], "record_id long, flood_risk_score double").write.csv(train, header=True)
    spark.createDataFrame([(2, "p")], "record_id long, soil_type string").write.csv(test, header=True)
    rows = {r[config.ID]: r for r in delimited.load_pair(spark, train, test).collect()}
    assert rows[1]["split"] == "train" and rows[1]["soil_type"] is None
    assert rows[2]["split"] == "test" and rows[2]["flood_risk_score"] is None
