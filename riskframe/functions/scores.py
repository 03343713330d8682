"""Model scores as aggregate expressions: usable in any `agg`, grouped or not."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def mae(y: Column, p: Column) -> Column:
    return F.avg(F.abs(y - p))


def rmse(y: Column, p: Column) -> Column:
    return F.sqrt(F.avg((y - p) * (y - p)))


def r2(y: Column, p: Column) -> Column:
    """1 − SSE/SST; for a constant target 1 when perfect and 0 otherwise."""
    return r2_from(F.avg((y - p) * (y - p)), F.var_pop(F.when(p.isNotNull(), y)))


def r2_from(mse: Column, variance: Column) -> Column:
    flat = F.when(mse == 0, F.lit(1.0)).otherwise(F.lit(0.0))
    return F.when(variance == 0, flat).otherwise(
        F.lit(1.0) - F.try_divide(mse, variance))


def penalised(mae_: Column, rmse_: Column, r2_: Column) -> Column:
    """Mean of MAE and RMSE, scaled up by what is left unexplained. Lower is better."""
    return (mae_ + rmse_) / 2 * (F.lit(1.0) + F.greatest(F.lit(0.0), F.lit(1.0) - r2_))


def custom_metric(y: Column, p: Column) -> Column:
    return penalised(mae(y, p), rmse(y, p), r2(y, p))


def score_columns(y: Column, p: Column) -> list[Column]:
    """The four scores of one prediction column, for a single `agg`."""
    return [mae(y, p).alias("mae"), rmse(y, p).alias("rmse"), r2(y, p).alias("r2"),
            custom_metric(y, p).alias("custom")]
