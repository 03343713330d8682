"""The lattice minimiser against closed forms and against all points of a lattice."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe import config
from riskframe.functions.scores import custom_metric, mae, r2, rmse
from riskframe.operators import ensemble, minimise

T = config.TARGET


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(1)
    y = rng.uniform(size=300)
    rows = [(float(v), *(float(v * a + b + rng.normal(0, s)) for a, b, s in ((0.7, 0.2, 0.1), (0.2, 0.5, 0.2), (1.3, -0.2, 0.3), (0, 0.4, 0.05))))
            for v in y]
    df = spark.createDataFrame(rows, f"{T} double, a double, b double, c double, d double").persist()
    return df, np.array(rows)


@pytest.mark.parametrize("models", ["ab", "abc", "abcd"])
def test_least_squares_weights(table, models):
    df, _ = table
    weights, found = minimise.best_blend(df, list(models), rmse)
    exact = ensemble.optimal_weights(df, list(models))
    assert sum(weights.values()) == pytest.approx(1.0)
    assert all(abs(weights[m] - exact[m]) <= 2e-3 for m in models)
    assert found.scans < 60


@pytest.mark.parametrize("score,plain", [
    (mae, lambda y, p: np.abs(y - p).mean()), (custom_metric, lambda y, p: (np.abs(y - p).mean() + np.sqrt(((y - p) ** 2).mean())) / 2
                                               * (1 + max(0, ((y - p) ** 2).mean() / y.var()))),
    (lambda y, p: F.max(F.abs(y - p)), lambda y, p: np.abs(y - p).max())])
def test_equals_every_point_of_the_lattice(table, score, plain):
    df, rows = table
    weights, found = minimise.best_blend(df, ["a", "b"], score, unit=0.01, reach=64)
    tried = {round(i * 0.01, 2): plain(rows[:, 0], i * 0.01 * rows[:, 1] + (1 - i * 0.01) * rows[:, 2]) for i in range(-200, 301)}
    assert found.score == pytest.approx(min(tried.values()), abs=1e-12)
    assert weights["a"] == pytest.approx(min(tried, key=lambda w: (tried[w], w)))


def test_two_values_and_bounds(table):
    df, rows = table
    found = minimise.lattice_minimum(df, lambda v: v[0] + v[1] * F.col("a"), rmse, [0.0, 0.0], reach=1024)
    slope, base = np.polyfit(rows[:, 1], rows[:, 0], 1)
    assert abs(found.values[0] - base) <= 2e-3 and abs(found.values[1] - slope) <= 2e-3
    held = minimise.lattice_minimum(df, lambda v: v[0] + F.col("a") * 0, rmse, [0.2], bounds=[(0.0, 0.3)])
    assert held.values == [pytest.approx(0.3)]
    lower = minimise.lattice_minimum(df, lambda v: v[0] * F.col("a"), lambda y, p: -r2(y, p), [1.0])
    assert lower.values[0] == pytest.approx((rows[:, 0] @ rows[:, 1]) / (rows[:, 1] @ rows[:, 1]), abs=1e-3)


def test_flat_scores_and_no_rows(spark, table):
    df, _ = table
    flat = minimise.lattice_minimum(df, lambda v: F.lit(0.5), mae, [1.0], reach=2)
    assert flat.score == pytest.approx(df.agg(mae(F.col(T), F.lit(0.5))).first()[0])
    none = minimise.lattice_minimum(df.limit(0), lambda v: v[0] * F.col("a"), mae, [1.0], reach=4, max_scans=9)
    assert none.score == float("inf")
