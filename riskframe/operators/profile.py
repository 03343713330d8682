"""Data profile: the numbers behind the exploratory plots, as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskframe import config
from riskframe.functions.hashing import seeded_digest
from riskframe.operators.columns import split_kinds
from riskframe.operators.quantiles import exact_quantiles, quantile_values
from riskframe.operators.rows import sample_exact, top_k


def _rows(df: DataFrame, structs) -> DataFrame:
    """A one-row table of structs as one row per struct."""
    return df.select(F.inline(F.array(*structs)))


def table_shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("rows")).withColumn("columns", F.lit(len(df.columns)))


def missing_report(df: DataFrame, columns=None) -> DataFrame:
    """Percent missing of every column that has any, highest first; one pass."""
    names = list(columns or df.columns)
    shares = df.agg(*[(F.avg(F.col(c).isNull().cast("int")) * 100).alias(c) for c in names])
    return _rows(shares, [F.struct(F.lit(c).alias("column"), F.col(c).alias("percent"))
                          for c in names]).filter(F.col("percent") > 0).orderBy(
        F.col("percent").desc(), "column")


def describe(df: DataFrame, columns: list[str]) -> DataFrame:
    """Count, mean, sample std, min, exact quartiles and max per column."""
    aggregates = [F.count("*")]
    for c in columns:
        aggregates += [F.count(c), F.avg(c), F.stddev_samp(c), F.min(c).cast("double"),
                       F.max(c).cast("double")]
    got = df.agg(*aggregates).first()
    quarters = quantile_values(df, columns, [0.25, 0.5, 0.75], rows=got[0])
    rows = []
    for i, c in enumerate(columns):
        n, mean, std, low, high = got[1 + 5 * i:6 + 5 * i]
        rows.append((c, n, mean, std, low, *quarters[c], high))
    return df.sparkSession.createDataFrame(
        rows, "column string, count long, mean double, std double, min double, p25 double, "
              "p50 double, p75 double, max double")


def correlations(df: DataFrame, columns: list[str], target: str = config.TARGET) -> DataFrame:
    """Pearson correlation with the target over the rows where both exist; one pass."""
    wide = df.agg(*[F.corr(F.col(c).cast("double"), F.col(target)).alias(c) for c in columns])
    return _rows(wide, [F.struct(F.lit(c).alias("column"), F.col(c).alias("corr"))
                        for c in columns]).orderBy("corr", "column")


def correlation_extremes(df: DataFrame, columns: list[str], k: int = 10,
                         target: str = config.TARGET) -> DataFrame:
    """The k highest and the k lowest correlations, told apart by `side`."""
    found = correlations(df, columns, target).filter(F.col("corr").isNotNull())
    return top_k(found, "corr", k, tie="column").withColumn("side", F.lit("top")).union(
        top_k(found, "corr", k, ascending=True, tie="column").withColumn("side", F.lit("bottom")))


def numeric_features(df: DataFrame, target: str = config.TARGET) -> list[str]:
    return [c for c in split_kinds(df)[0] if c not in (target, config.ID)]


def histogram(df: DataFrame, column: str, bins: int = 50) -> DataFrame:
    """Counts in equal-width bins, the last one closed; empty bins are left out."""
    low, high = df.agg(F.min(column), F.max(column)).first()
    if low is None:
        return df.sparkSession.createDataFrame([], "bin int, count bigint, bin_low double")
    if low == high:
        low, high = low - 0.5, high + 0.5
    place = F.least(F.floor((F.col(column) - F.lit(low)) / F.lit(high - low) * bins),
                    F.lit(bins - 1)).cast("int")
    return df.filter(F.col(column).isNotNull()).groupBy(place.alias("bin")).agg(
        F.count("*").alias("count")).withColumn(
        "bin_low", F.lit(low) + F.col("bin") * F.lit((high - low) / bins))


def density_curve(df: DataFrame, column: str, points: int = 1000) -> DataFrame:
    """Gaussian kernel density on an even grid, half the value range beyond both ends.

    Bandwidth n^(−1/5) · sample std. A value adds only to grid points nearer than 9
    bandwidths, where the kernel is above 1e-18 of its peak; the span in grid steps shrinks
    as n grows. The sums combine before the shuffle, so it moves one row per grid point and
    task, whatever the number of values.
    """
    low, high, n, std = df.agg(F.min(column), F.max(column), F.count(column),
                               F.stddev_samp(column)).first()
    if not std:
        raise ValueError("a density curve needs values that vary")
    start, stop = low - 0.5 * (high - low), high + 0.5 * (high - low)
    step = (stop - start) / (points - 1)
    width = std * n ** -0.2
    values = df.filter(F.col(column).isNotNull()).select(F.col(column).alias("v"))
    span = 9 * width
    near = F.sequence(
        F.greatest(F.ceil((F.col("v") - span - start) / step), F.lit(0)).cast("int"),
        F.least(F.floor((F.col("v") + span - start) / step), F.lit(points - 1)).cast("int"))
    z = (F.lit(start) + F.col("i") * F.lit(step) - F.col("v")) / F.lit(width)
    sums = values.select("v", F.explode(near).alias("i")).groupBy("i").agg(
        F.sum(F.exp(F.lit(-0.5) * z * z)).alias("total"))
    grid = df.sparkSession.range(points).select(F.col("id").cast("int").alias("i"))
    scale = 1.0 / (n * width * (2 * 3.141592653589793) ** 0.5)
    return grid.join(F.broadcast(sums), "i", "left").select(
        F.col("i").alias("point"), (F.lit(start) + F.col("i") * F.lit(step)).alias("x"),
        (F.coalesce("total", F.lit(0.0)) * F.lit(scale)).alias("density"))


def median_order(df: DataFrame, by: str, column: str) -> DataFrame:
    """Groups by ascending median."""
    found = exact_quantiles(df.filter(F.col(by).isNotNull()), [column], [0.5], [by])
    return found.select(by, F.get("quantiles", F.lit(0)).alias("median")).orderBy("median", by)


def box_stats(df: DataFrame, by: str, column: str) -> DataFrame:
    """Quartiles, whiskers (furthest value within 1.5 IQR) and outlier count per group."""
    from riskframe.operators.joins import lookup_join

    known = df.filter(F.col(by).isNotNull() & F.col(column).isNotNull()).select(by, column)
    boxes = exact_quantiles(known, [column], [0.25, 0.5, 0.75], [by]).select(
        by, *[F.get("quantiles", F.lit(i)).alias(q) for i, q in enumerate(("q1", "median", "q3"))])
    reach = F.lit(1.5) * (F.col("q3") - F.col("q1"))
    inside = F.col(column).between(F.col("q1") - reach, F.col("q3") + reach)
    return lookup_join(known, boxes, by).groupBy(by, "q1", "median", "q3").agg(
        F.min(F.when(inside, F.col(column))).alias("whisker_low"),
        F.max(F.when(inside, F.col(column))).alias("whisker_high"),
        F.count(F.when(~inside, 1)).alias("outliers"))


def map_sample(df: DataFrame, n: int = 5000, target: str = config.TARGET) -> DataFrame:
    """Located rows for a map: id, longitude, latitude, target."""
    located = df.na.drop(subset=list(config.COORDINATES))
    return sample_exact(located.select(config.ID, "longitude", "latitude", target), n)


def scatter_sample(df: DataFrame, columns: list[str] = config.SCATTER_COLUMNS, n: int = 3000,
                   target: str = config.TARGET) -> DataFrame:
    """(pair, id, x, y): for each column its own sample of the rows with both values.

    One scan; each task keeps its first n rows of a pair in digest order before they meet.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("pair"), F.col(c).cast("double").alias("x"))
                      for c in columns if c in df.columns])
    rows = df.filter(F.col(target).isNotNull()).select(
        config.ID, F.col(target).alias("y"), F.inline(pairs)).filter("x IS NOT NULL")
    order = Window.partitionBy("pair").orderBy(seeded_digest(F.col(config.ID), config.SEED), config.ID)
    return rows.withColumn("_place", F.row_number().over(order)).filter(
        F.col("_place") <= n).select("pair", config.ID, "x", "y")
