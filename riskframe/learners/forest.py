"""Random forest and its feature importances."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe import config
from riskframe.learners.base import FeatureSet, Learner, MlModel, bins_needed
from riskframe.operators.columns import feature_columns, split_kinds
from riskframe.operators.encode import category_codes
from riskframe.operators.rows import train_rows


@dataclass
class Forest(Learner):
    name: str = "forest"
    trees: int = 100
    depth: int = 8
    seed: int = config.SEED

    def fit(self, train: DataFrame, valid: DataFrame | None = None) -> MlModel:
        return MlModel(RandomForestRegressor(
            featuresCol="features", labelCol=config.TARGET, numTrees=self.trees,
            maxDepth=self.depth, featureSubsetStrategy="all", maxMemoryInMB=512,
            maxBins=bins_needed(train, 64), seed=self.seed).fit(train))


def feature_importance(df: DataFrame, trees: int = 100, depth: int = 8) -> DataFrame:
    """(feature, importance), highest first: codes for categories, −999 for missing."""
    train = train_rows(df)
    features = feature_columns(train, profile="core")
    _, categories = split_kinds(train, features)
    coded = category_codes(train, categories)
    names = [f"{c}_code" if c in categories else c for c in features]
    data = FeatureSet(names).assemble(coded, None).persist()
    try:
        model = Forest(trees=trees, depth=depth).fit(data).model
    finally:
        data.unpersist()
    weights = model.featureImportances.toArray()
    return df.sparkSession.createDataFrame(
        [(f, float(w)) for f, w in zip(features, weights)],
        "feature string, importance double").orderBy(F.col("importance").desc(), "feature")
