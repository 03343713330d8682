"""Scores, blends and calibration against NumPy."""
import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from riskframe import config
from riskframe.functions import scores
from riskframe.operators import ensemble, evaluation

SCHEMA = "flood_risk_score double, p double"


def custom(y, p):
    err = y - p
    sst = ((y - y.mean()) ** 2).sum()
    r2 = 1 - (err ** 2).sum() / sst if sst else float((err ** 2).sum() == 0)
    return (np.abs(err).mean() + np.sqrt((err ** 2).mean())) / 2 * (1 + max(0, 1 - r2))


def frame(spark, y, p):
    return spark.createDataFrame([(float(a), float(b)) for a, b in zip(y, p)], SCHEMA)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.floats(0, 1), st.floats(0, 1)), min_size=3, max_size=30))
def test_custom_metric_property(spark, pairs):
    y, p = np.array(pairs).T
    if np.ptp(y) < 1e-3:
        return
    got = evaluation.custom_score(frame(spark, y, p), "p").first()[0]
    assert got == pytest.approx(custom(y, p), rel=1e-6)


def test_r2_of_a_constant_target(spark):
    r2 = scores.r2(F.col("flood_risk_score"), F.col("p"))
    assert frame(spark, [0.5, 0.5], [0.5, 0.5]).agg(r2).first()[0] == 1.0
    assert frame(spark, [0.5, 0.5], [0.5, 0.6]).agg(r2).first()[0] == 0.0


@pytest.fixture(scope="module")
def models(spark):
    rng = np.random.default_rng(3)
    y = rng.uniform(0, 1, 400)
    cols = {"a": y + rng.normal(0, 0.2, 400), "b": 0.5 * y + rng.normal(0.25, 0.1, 400),
            "c": np.full(400, 0.5) + rng.normal(0, 0.05, 400)}
    cols["d"] = cols["a"]
    names = list(cols)
    df = spark.createDataFrame(
        [(float(t), *[float(cols[n][i]) for n in names]) for i, t in enumerate(y)],
        "flood_risk_score double, " + ", ".join(f"{n} double" for n in names)).persist()
    return df, y, cols


def test_weights_beat_every_model_and_sum_to_one(models):
    df, y, cols = models
    w = ensemble.optimal_weights(df, ["a", "b", "c"])
    assert sum(w.values()) == pytest.approx(1)
    blend = sum(w[m] * cols[m] for m in w)
    best = np.sqrt(((y - blend) ** 2).mean())
    assert all(best <= np.sqrt(((y - cols[m]) ** 2).mean()) + 1e-12 for m in w)
    for m in w:                                    # no better neighbour on the plane
        for o in w:
            if m != o:
                v = dict(w)
                v[m] += 1e-3
                v[o] -= 1e-3
                assert np.sqrt(((y - sum(v[k] * cols[k] for k in v)) ** 2).mean()) >= best


def test_equal_models_share_their_weight(models):
    df, _, _ = models
    two = ensemble.optimal_weights(df, ["a", "b"])
    dup = ensemble.optimal_weights(df, ["a", "b", "d"])
    assert dup["a"] == pytest.approx(dup["d"]) and dup["a"] + dup["d"] == pytest.approx(two["a"])


def test_ablation_matches_refitting(models):
    df, y, cols = models
    got = {r["left_out"]: r["rmse_without"] for r in
           ensemble.blend_ablation(df, ["a", "b", "c"]).collect()}
    w = ensemble.optimal_weights(df, ["b", "c"])
    assert got["a"] == pytest.approx(np.sqrt(((y - w["b"] * cols["b"] - w["c"] * cols["c"]) ** 2).mean()))


def stretched(p, centre, f):
    return np.clip(centre + (p - centre) * f, 0, 1)


@pytest.mark.parametrize("shift", [0.0, 0.9, -0.9])
def test_calibration_curve_equals_direct_scores(spark, shift):
    rng = np.random.default_rng(5)
    y, p = rng.uniform(0, 1, 300), rng.uniform(-0.3, 1.3, 300) + shift
    p[:10], p[10:20] = p.mean(), 0.5
    df = frame(spark, y, p)
    curve = ensemble.calibration_curve(df, "p", step=0.01).toPandas()
    assert len(curve) == 751
    for i in range(0, 751, 25):
        q = stretched(p, p.mean(), curve.factor[i])
        assert curve.mae[i] == pytest.approx(np.abs(y - q).mean(), abs=1e-9)
        assert curve.rmse[i] == pytest.approx(np.sqrt(((y - q) ** 2).mean()), abs=1e-9)
        assert curve.custom[i] == pytest.approx(custom(y, q), abs=1e-8)
    factor, score = ensemble.best_calibration(df, "p", step=0.01)
    assert score == pytest.approx(curve.custom.min()) and factor in set(curve.factor)


def test_factor_one_is_clip_only(spark):
    df = frame(spark, [0.1, 0.9], [-0.2, 0.8])
    centre = ensemble.blend_centre(df, "p")
    assert [r[0] for r in df.select(ensemble.calibrated(F.col("p"), centre, 1.0)).collect()] == \
        pytest.approx([0.0, 0.8])


def test_spread_uses_population_and_sample_std(spark):
    y, p = [0.1, 0.5, 0.9], [0.4, 0.5, 0.8]
    row = evaluation.spread_report(frame(spark, y, p), "p").first()
    assert row["pred_std"] == pytest.approx(np.std(p)) and row["target_std"] == pytest.approx(
        np.std(y, ddof=1))


def test_empty_classes_score_zero(spark):
    rows = evaluation.class_report(frame(spark, [0.1, 0.2], [0.3, 0.4]), "p").collect()
    flood = next(r for r in rows if r["class"] == 1)
    assert (flood["precision"], flood["recall"], flood["f1"], flood["accuracy"]) == (0, 0, 0, 1)


def test_fixed_grid():
    assert config.CALIBRATION_FACTORS[0] == 1.0 and len(config.CALIBRATION_FACTORS) == 9
