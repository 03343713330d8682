"""Group statistics and the features made from them."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe import config
from riskframe.operators.joins import lookup_join, pin_small
from riskframe.operators.quantiles import quantile_values
from riskframe.operators.rows import train_rows


def scalar_stats(df: DataFrame, column: str) -> DataFrame:
    """One row: mean, sample std, min, max and exact median."""
    got = df.agg(F.avg(column), F.stddev_samp(column), F.min(column), F.max(column),
                 F.count("*")).first()
    median = quantile_values(df, [column], [0.5], rows=got[4])[column][0]
    return df.sparkSession.createDataFrame(
        [(*[None if v is None else float(v) for v in got[:4]], median)],
        "mean double, std double, min double, max double, median double")


def range_and_median(df: DataFrame, column: str) -> dict[str, float]:
    """Train scalars a feature formula needs, as plain numbers."""
    low, high, rows = df.agg(F.min(column), F.max(column), F.count("*")).first()
    return {"min": low, "max": high,
            "median": quantile_values(df, [column], [0.5], rows=rows)[column][0]}


def group_mean(df: DataFrame, by: str, column: str, alias: str = "mean") -> DataFrame:
    """Mean per group; a null key is no group."""
    return df.filter(F.col(by).isNotNull()).groupBy(by).agg(F.avg(column).alias(alias))


def group_risk_rank(df: DataFrame, by: str, column: str) -> DataFrame:
    """Mean, sample std and count per group, highest mean first."""
    return df.filter(F.col(by).isNotNull()).groupBy(by).agg(
        F.avg(column).alias("mean"), F.stddev_samp(column).alias("std"),
        F.count(column).alias("count")).orderBy(F.col("mean").desc(), F.col(by))


def value_counts(df: DataFrame, by: str) -> DataFrame:
    """Rows per label in label order; null labels left out."""
    return df.filter(F.col(by).isNotNull()).groupBy(by).count().orderBy(by)


def count_range(counts: DataFrame) -> DataFrame:
    """Smallest, largest and mean group size."""
    return counts.agg(F.min("count").alias("min_count"), F.max("count").alias("max_count"),
                      F.avg("count").alias("mean_count"))


def group_stats(df: DataFrame, by: str, columns: list[str]) -> DataFrame:
    """Count, mean and sample std of many columns in one aggregation; null key kept."""
    aggregates = []
    for c in columns:
        aggregates += [F.count(c).alias(f"{c}_n"), F.avg(c).alias(f"{c}_mean"),
                       F.stddev_samp(c).alias(f"{c}_std")]
    return df.groupBy(by).agg(*aggregates)


def _combine(rows: list[dict], column: str) -> tuple[float | None, float | None]:
    """Overall mean and sample std from the per-group count, mean and std."""
    parts = [(r[f"{column}_n"], r[f"{column}_mean"], r[f"{column}_std"] or 0.0)
             for r in rows if r[f"{column}_n"]]
    n = sum(p[0] for p in parts)
    if n == 0:
        return None, None
    mean = math.fsum(k * m for k, m, _ in parts) / n
    if n == 1:
        return mean, None
    spread = math.fsum((k - 1) * s * s + k * (m - mean) ** 2 for k, m, s in parts)
    return mean, math.sqrt(spread / (n - 1))


def add_group_stats(df: DataFrame, by: str = "district",
                    columns: list[str] = config.GROUP_STAT_COLUMNS,
                    combined: bool = False) -> DataFrame:
    """`{by}_{c}_mean` and `{by}_{c}_std` for every row, fitted on the train rows.

    Rows of an unseen or null group, and groups whose statistic is null, take the overall
    train value. `combined=True` fits on train and test together instead.
    One pass over the data yields both the group and the overall values.
    """
    columns = [c for c in columns if c in df.columns]
    source = df if combined else train_rows(df)
    stats = group_stats(source, by, columns)
    pinned = pin_small(stats)
    if pinned is not None:
        rows = [r.asDict() for r in pinned.collect()]
        overall = {c: _combine(rows, c) for c in columns}
        stats = pinned
    else:
        got = source.agg(*[f(c).alias(f"{n}_{i}") for i, c in enumerate(columns)
                           for n, f in (("m", F.avg), ("s", F.stddev_samp))]).first()
        overall = {c: (got[f"m_{i}"], got[f"s_{i}"]) for i, c in enumerate(columns)}
    names = {f"{c}_{k}": f"{by}_{c}_{k}" for c in columns for k in ("mean", "std")}
    lookup = stats.filter(F.col(by).isNotNull()).select(
        by, *[F.col(a).alias(b) for a, b in names.items()])
    joined = lookup_join(df, lookup, by, pinned=pinned is not None)
    defaults = {f"{by}_{c}_{k}": overall[c][i] for c in columns
                for i, k in enumerate(("mean", "std"))}
    return joined.withColumns({
        name: F.coalesce(F.col(name), F.lit(value).cast("double"))
        for name, value in defaults.items()})


def group_transform(df: DataFrame, by: str, columns: list[str]) -> DataFrame:
    """Group mean and std next to every row, fitted on all rows; null key gives null.

    Aggregate and look up rather than a window over the key: a window would gather each
    group, however large, in one task.
    """
    stats = df.filter(F.col(by).isNotNull()).groupBy(by).agg(
        *[f(c).alias(f"{by}_{c}_{k}") for c in columns
          for k, f in (("mean", F.avg), ("std", F.stddev_samp))])
    return lookup_join(df, stats, by)


def add_relative_features(df: DataFrame, by: str = "district",
                          columns: list[str] = config.RELATIVE_COLUMNS,
                          zscore: str | None = "rainfall_7d_mm",
                          zscore_name: str = "rainfall_district_zscore") -> DataFrame:
    """Value minus group mean, and one damped z-score, from `add_group_stats` columns."""
    made = {f"rel_{c}": F.col(c) - F.col(f"{by}_{c}_mean") for c in columns
            if c in df.columns and f"{by}_{c}_mean" in df.columns}
    if zscore:
        made[zscore_name] = F.try_divide(
            F.col(zscore) - F.col(f"{by}_{zscore}_mean"),
            F.col(f"{by}_{zscore}_std") + F.lit(0.01))
    return df.withColumns(made)
