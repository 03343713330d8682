"""Blending and calibration. Every search works on a few sums over the rows."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe import config
from riskframe.functions.features import clip_unit
from riskframe.functions.scores import penalised, r2_from


def simple_blend(models: list[str]) -> Column:
    return sum((F.col(m) for m in models[1:]), F.col(models[0])) / len(models)


def weighted_blend(weights: dict[str, float]) -> Column:
    terms = [F.lit(float(w)) * F.col(m) for m, w in weights.items()]
    return sum(terms[1:], terms[0])


# --- optimal weights -------------------------------------------------------

def gram_matrix(df: DataFrame, models: list[str], target: str = config.TARGET) -> DataFrame:
    """(row_model, col_model, value): mean product of residuals, upper triangle."""
    pairs = [(a, b) for i, a in enumerate(models) for b in models[i:]]
    y = F.col(target)
    wide = df.agg(*[F.avg((F.col(a) - y) * (F.col(b) - y)).alias(f"_{i}")
                    for i, (a, b) in enumerate(pairs)])
    return wide.select(F.inline(F.array(*[
        F.struct(F.lit(a).alias("row_model"), F.lit(b).alias("col_model"),
                 F.col(f"_{i}").alias("value")) for i, (a, b) in enumerate(pairs)])))


def _as_matrix(gram: DataFrame, models: list[str]) -> np.ndarray:
    at = {m: i for i, m in enumerate(models)}
    matrix = np.zeros((len(models), len(models)))
    for r in gram.collect():                       # k(k+1)/2 rows
        i, j = at[r["row_model"]], at[r["col_model"]]
        matrix[i, j] = matrix[j, i] = r["value"]
    return matrix


def solve_weights(matrix: np.ndarray) -> np.ndarray:
    """Weights with sum 1 that minimise wᵀEw; they may be negative.

    The bordered system is solved by least squares, so equal models share the weight.
    """
    k = len(matrix)
    scale = float(np.trace(matrix)) / k or 1.0
    bordered = np.zeros((k + 1, k + 1))
    bordered[:k, :k] = matrix / scale
    bordered[:k, k] = bordered[k, :k] = 1.0
    right = np.zeros(k + 1)
    right[k] = 1.0
    w = np.linalg.lstsq(bordered, right, rcond=1e-12)[0][:k]
    return w / w.sum()


def blend_error(matrix: np.ndarray, w: np.ndarray) -> float:
    return float(np.sqrt(max(0.0, w @ matrix @ w)))


def optimal_weights(df: DataFrame, models: list[str], target: str = config.TARGET
                    ) -> dict[str, float]:
    w = solve_weights(_as_matrix(gram_matrix(df, models, target), models))
    return dict(zip(models, map(float, w)))


def optimal_blend(df: DataFrame, models: list[str], target: str = config.TARGET) -> DataFrame:
    """(model, weight, model_rmse, blend_rmse)."""
    matrix = _as_matrix(gram_matrix(df, models, target), models)
    w = solve_weights(matrix)
    best = blend_error(matrix, w)
    return df.sparkSession.createDataFrame(
        [(m, float(w[i]), float(np.sqrt(matrix[i, i])), best) for i, m in enumerate(models)],
        "model string, weight double, model_rmse double, blend_rmse double")


def blend_ablation(df: DataFrame, models: list[str], target: str = config.TARGET) -> DataFrame:
    """RMSE of the best blend without each model and what the model adds; one pass."""
    matrix = _as_matrix(gram_matrix(df, models, target), models)
    full = blend_error(matrix, solve_weights(matrix))
    rows = []
    for i, m in enumerate(models):
        rest = [j for j in range(len(models)) if j != i]
        part = matrix[np.ix_(rest, rest)]
        without = blend_error(part, solve_weights(part))
        rows.append((m, full, without, without - full))
    return df.sparkSession.createDataFrame(
        rows, "left_out string, full_rmse double, rmse_without double, contribution double")


def leaderboard(df: DataFrame, models: list[str], baseline: float,
                target: str = config.TARGET) -> DataFrame:
    """RMSE of each model, the simple and the optimal blend, and the gain over a baseline."""
    matrix = _as_matrix(gram_matrix(df, models, target), models)
    even = np.full(len(models), 1 / len(models))
    rows = [(m, float(np.sqrt(matrix[i, i]))) for i, m in enumerate(models)]
    rows += [("simple_blend", blend_error(matrix, even)),
             ("optimal_blend", blend_error(matrix, solve_weights(matrix)))]
    board = df.sparkSession.createDataFrame(rows, "model string, rmse double")
    return board.withColumn("improvement", F.lit(float(baseline)) - F.col("rmse")).orderBy("rmse")


# --- calibration -----------------------------------------------------------

def calibrated(prediction: Column, centre: float, factor: float) -> Column:
    """Stretch around the centre, then limit to [0, 1]."""
    return clip_unit(F.lit(centre) + (prediction - F.lit(centre)) * F.lit(float(factor)))


def blend_centre(df: DataFrame, prediction: str) -> float:
    """Mean prediction of the train rows, also used for test."""
    return df.agg(F.avg(prediction)).first()[0]


def calibration_grid(df: DataFrame, prediction: str, factors=None,
                     target: str = config.TARGET, centre: float | None = None) -> DataFrame:
    """Scores after calibrating with each factor, all factors in one pass."""
    factors = list(factors or config.CALIBRATION_FACTORS)
    centre = blend_centre(df, prediction) if centre is None else centre
    y = F.col(target)
    stretched = df.select(y.alias("_y"), *[
        calibrated(F.col(prediction), centre, f).alias(f"_p{i}") for i, f in enumerate(factors)])
    y = F.col("_y")
    aggregates = [F.var_pop(y).alias("_v")]
    for i in range(len(factors)):
        p = F.col(f"_p{i}")
        aggregates += [F.avg(F.abs(y - p)).alias(f"_a{i}"),
                       F.avg((y - p) * (y - p)).alias(f"_q{i}"),
                       F.stddev_pop(p).alias(f"_s{i}")]
    sums = stretched.agg(*aggregates)
    rows = []
    for i, f in enumerate(factors):
        err, r = F.sqrt(f"_q{i}"), r2_from(F.col(f"_q{i}"), F.col("_v"))
        rows.append(F.struct(
            F.lit(float(f)).alias("factor"), err.alias("rmse"), F.col(f"_a{i}").alias("mae"),
            r.alias("r2"), penalised(F.col(f"_a{i}"), err, r).alias("custom"),
            F.col(f"_s{i}").alias("pred_std")))
    return sums.select(F.inline(F.array(*rows)))


def calibration_curve(df: DataFrame, prediction: str, target: str = config.TARGET,
                      bounds=config.CALIBRATION_BOUNDS, step: float = 1e-3) -> DataFrame:
    """(factor, mae, rmse, r2, custom) on a fine even grid of factors, in one pass.

    As the factor grows, a row's calibrated value is constant (limited), then linear, then
    constant again, and its error changes sign once. So each row adds polynomial terms in
    the factor at four grid positions instead of an error at every factor; running sums
    over the positions give the exact totals. Rows combine by position before the shuffle,
    and one row per grid position reaches the driver.
    """
    low, high = bounds
    last = round((high - low) / step)
    centre, variance, n = df.filter(F.col(prediction).isNotNull() & F.col(target).isNotNull()).agg(
        F.avg(prediction), F.var_pop(target), F.count("*")).first()
    y = F.col(target)
    d, a = F.col(prediction) - F.lit(centre), y - F.lit(centre)

    def first_index(t: Column) -> Column:
        at = F.ceil((F.greatest(F.lit(low), F.least(F.lit(high + step), t)) - low) / step)
        return at.cast("int")

    rows = df.filter(F.col(prediction).isNotNull() & y.isNotNull()).select(
        y.alias("y"), d.alias("d"), a.alias("a"))
    still = F.col("d") == 0
    to_zero = F.try_divide(F.lit(-centre), F.col("d"))
    to_one = F.try_divide(F.lit(1.0 - centre), F.col("d"))
    end = F.lit(last + 1)
    rows = rows.select(
        "y", "a", "d",
        F.when(still, end).otherwise(first_index(F.least(to_zero, to_one))).alias("enter"),
        F.when(still, end).otherwise(first_index(F.greatest(to_zero, to_one))).alias("leave"),
        F.when(still, end).otherwise(first_index(F.try_divide("a", "d"))).alias("turn"),
        F.when(still, F.lit(min(1.0, max(0.0, centre)))).when(F.col("d") > 0, 0.0)
        .otherwise(1.0).alias("before"),
        F.when(F.col("d") > 0, 1.0).otherwise(0.0).alias("after"),
        F.when(F.col("d") > 0, 1.0).otherwise(-1.0).alias("sign"))

    def event(at, q0, q1, q2, m0, m1):
        return F.struct(at.cast("int").alias("at"), *[
            v.cast("double").alias(k) for k, v in (
                ("q0", q0), ("q1", q1), ("q2", q2), ("m0", m0), ("m1", m1))])

    zero = F.lit(0.0)
    y, a, d, sign = (F.col(c) for c in ("y", "a", "d", "sign"))
    fixed = [(y - F.col(c), F.abs(y - F.col(c))) for c in ("before", "after")]
    linear = (a * a, -2 * a * d, d * d)
    turn = F.greatest(F.col("enter"), F.least(F.col("leave"), F.col("turn")))
    events = F.array(
        event(F.lit(0), fixed[0][0] * fixed[0][0], zero, zero, fixed[0][1], zero),
        event(F.col("enter"), linear[0] - fixed[0][0] * fixed[0][0], linear[1], linear[2],
              sign * a - fixed[0][1], -sign * d),
        event(turn, zero, zero, zero, -2 * sign * a, 2 * sign * d),
        event(F.col("leave"), fixed[1][0] * fixed[1][0] - linear[0], -linear[1], -linear[2],
              fixed[1][1] + sign * a, -sign * d))
    terms = ["q0", "q1", "q2", "m0", "m1"]
    sums = rows.select(F.inline(events)).filter(F.col("at") <= last).groupBy("at").agg(
        *[F.sum(c).alias(c) for c in terms]).toPandas().set_index("at")
    running = {c: sums[c].reindex(range(last + 1), fill_value=0.0).cumsum().to_numpy()
               for c in terms}
    f = low + np.arange(last + 1) * step
    mse = np.maximum(0.0, running["q0"] + running["q1"] * f + running["q2"] * f * f) / n
    mean = (running["m0"] + running["m1"] * f) / n
    root = np.sqrt(mse)
    r2 = 1 - mse / variance if variance else np.where(mse == 0, 1.0, 0.0)
    custom = (mean + root) / 2 * (1 + np.maximum(0.0, 1 - r2))
    return df.sparkSession.createDataFrame(pd.DataFrame(
        {"factor": f, "mae": mean, "rmse": root, "r2": r2, "custom": custom}))


def best_calibration(df: DataFrame, prediction: str, target: str = config.TARGET,
                     bounds=config.CALIBRATION_BOUNDS, step: float = 1e-3
                     ) -> tuple[float, float]:
    """(factor, custom) with the lowest custom score on the whole grid."""
    best = calibration_curve(df, prediction, target, bounds, step).orderBy(
        "custom", "factor").first()
    return best["factor"], best["custom"]
