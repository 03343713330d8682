"""Scores of prediction columns as tables, each from one aggregation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe import config
from riskframe.functions.cleaning import above
from riskframe.functions.scores import custom_metric, mae, penalised, r2, rmse, score_columns


def regression_metrics(df: DataFrame, models: list[str], target: str = config.TARGET
                       ) -> DataFrame:
    """(model, mae, rmse, r2, custom) for every prediction column, in one pass."""
    return _per_model(df.agg(*_score_structs(models, target)), models, [])


def metrics_by_fold(df: DataFrame, models: list[str], fold: str = "fold",
                    target: str = config.TARGET) -> DataFrame:
    """Scores per (model, fold), and per model over all rows with a null fold.

    Rows without a fold count in the total only.
    """
    grouped = df.groupingSets([[F.col(fold)], []], F.col(fold)).agg(
        F.grouping_id().alias("_total"), *_score_structs(models, target))
    grouped = grouped.filter((F.col("_total") > 0) | F.col(fold).isNotNull())
    return _per_model(grouped, models, [fold])


def _score_structs(models, target):
    y = F.col(target)
    return [F.struct(F.lit(m).alias("model"), *score_columns(y, F.col(m))).alias(f"_{m}")
            for m in models]


def _per_model(scored: DataFrame, models, keys) -> DataFrame:
    return scored.select(*keys, F.inline(F.array(*[f"_{m}" for m in models])))


def mean_fold_score(by_fold: DataFrame, fold: str = "fold") -> DataFrame:
    """Mean over folds of each score, which differs from the score over all rows."""
    return by_fold.filter(F.col(fold).isNotNull()).groupBy("model").agg(
        *[F.avg(c).alias(c) for c in ("mae", "rmse", "r2", "custom")])


def custom_score(df: DataFrame, prediction: str, target: str = config.TARGET) -> DataFrame:
    return df.agg(custom_metric(F.col(target), F.col(prediction)).alias("custom"))


def confusion(df: DataFrame, prediction: str, target: str = config.TARGET,
              threshold: float = config.BINARY_THRESHOLD) -> DataFrame:
    """One row tn, fp, fn, tp after cutting both columns at the threshold."""
    y, p = above(F.col(target), threshold), above(F.col(prediction), threshold)

    def cell(actual, predicted):
        return F.count_if((y == actual) & (p == predicted))

    return df.agg(cell(0, 0).alias("tn"), cell(0, 1).alias("fp"), cell(1, 0).alias("fn"),
                  cell(1, 1).alias("tp"))


def class_report(df: DataFrame, prediction: str, target: str = config.TARGET,
                 threshold: float = config.BINARY_THRESHOLD) -> DataFrame:
    """Precision, recall, F1 and support per class plus overall accuracy; x/0 counts as 0."""
    def ratio(a, b):
        return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))

    cells = confusion(df, prediction, target, threshold)
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))

    def row(label, hit, wrong, missed):
        precision, recall = ratio(hit, hit + wrong), ratio(hit, hit + missed)
        return F.struct(
            F.lit(label).alias("class"), precision.alias("precision"), recall.alias("recall"),
            ratio(2 * precision * recall, precision + recall).alias("f1"),
            (hit + missed).alias("support"),
            ratio(tp + tn, tn + fp + fn + tp).alias("accuracy"))

    return cells.select(F.inline(F.array(row(0, tn, fn, fp), row(1, tp, fp, fn))))


def spread_report(df: DataFrame, prediction: str, target: str = config.TARGET) -> DataFrame:
    """Population std of predictions, sample std of the target, and target/prediction."""
    return df.agg(F.stddev_pop(prediction).alias("pred_std"),
                  F.stddev_samp(target).alias("target_std")).withColumn(
        "ratio", F.try_divide("target_std", "pred_std"))


__all__ = ["regression_metrics", "metrics_by_fold", "mean_fold_score", "custom_score",
           "confusion", "class_report", "spread_report", "mae", "rmse", "r2", "penalised"]
