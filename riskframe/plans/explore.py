"""The exploratory profile of a train table, one DataFrame per view."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe import config
from riskframe.functions.cleaning import coerce_numeric
from riskframe.learners.forest import feature_importance
from riskframe.operators.groups import group_mean, group_risk_rank
from riskframe.operators.profile import (
    box_stats, correlation_extremes, correlations, density_curve, describe, histogram,
    map_sample, median_order, missing_report, numeric_features, scatter_sample, table_shape)
from riskframe.operators.rows import train_rows


def explore(df: DataFrame, importance_trees: int = 100) -> dict[str, DataFrame]:
    """All views; each is lazy but for the scalars its formula needs."""
    train = train_rows(coerce_numeric(df)).drop(config.SPLIT)
    target = config.TARGET
    views = {
        "shape": table_shape(train),
        "target_summary": describe(train, [target]),
        "target_histogram": histogram(train, target),
        "target_density": density_curve(train, target),
        "missing": missing_report(train),
        "correlations": correlations(train, numeric_features(train)),
        "correlation_extremes": correlation_extremes(train, numeric_features(train)),
        "map": map_sample(train),
        "scatter": scatter_sample(train),
        "importance": feature_importance(df, importance_trees),
    }
    for c in config.PROFILE_CATEGORIES:
        if c in train.columns:
            views[f"order_{c}"] = median_order(train, c, target)
            views[f"box_{c}"] = box_stats(train, c, target)
    if "district" in train.columns:
        views["district_risk"] = group_risk_rank(train, "district", target)
    for c in ("district", "soil_type", "landcover"):
        if c in train.columns:
            views[f"encoding_{c}"] = group_mean(train, c, target).orderBy(F.col("mean").desc(), c)
    return views
