"""Union, split, row filters and reproducible samples."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe import config
from riskframe.functions.hashing import seeded_digest


def union_splits(train: DataFrame, test: DataFrame) -> DataFrame:
    """Both tables by column name; columns only one side has are null on the other."""
    return train.withColumn(config.SPLIT, F.lit(config.TRAIN)).unionByName(
        test.withColumn(config.SPLIT, F.lit(config.TEST)), allowMissingColumns=True)


def train_rows(df: DataFrame) -> DataFrame:
    return df.filter(F.col(config.SPLIT) == config.TRAIN)


def test_rows(df: DataFrame) -> DataFrame:
    return df.filter(F.col(config.SPLIT) == config.TEST)


def drop_missing(df: DataFrame, columns=None) -> DataFrame:
    return df.na.drop(subset=list(columns) if columns else None)


def sample_exact(df: DataFrame, n: int, id_col: str = config.ID,
                 seed: int = config.SEED) -> DataFrame:
    """Exactly min(n, rows) rows in digest order: per-partition top-n, then a merge.

    `n` must be small enough for one task; it is a plotting sample, not a data split.
    """
    return df.orderBy(seeded_digest(F.col(id_col), seed), F.col(id_col)).limit(n)


def top_k(df: DataFrame, by: str, k: int, ascending: bool = False, tie: str | None = None
          ) -> DataFrame:
    """First k rows by a metric; `tie` orders equal metrics."""
    order = [F.col(by).asc() if ascending else F.col(by).desc()]
    return df.orderBy(*order, *([F.col(tie).asc()] if tie else [])).limit(k)
