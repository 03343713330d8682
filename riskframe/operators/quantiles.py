"""Exact quantiles, with linear interpolation, at any size.

Up to MAX_BUFFERED_VALUES rows the built-in `percentile` is used: it keeps every distinct
value of a group in one buffer. Beyond that, sketches bracket each quantile first; only the
few values inside the brackets are shuffled and counted, and the brackets are cut further
until each fits one task. The result is exact either way.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskframe import config
from riskframe.operators.joins import pin_small
from riskframe.session import cut_lineage

_PIECES = 64


def exact_quantiles(df: DataFrame, columns: list[str], probs: list[float],
                    by: list[str] | None = None, rows: int | None = None,
                    buffered: int = config.MAX_BUFFERED_VALUES,
                    accuracy: int = 10_000) -> DataFrame:
    """Rows (by..., column, n, quantiles): non-null count and quantiles in `probs` order.

    `rows` is the row count of `df` where the caller knows it; it saves counting.
    """
    by = list(by or [])
    slim = df.select(*by, *[F.col(c).cast("double").alias(c) for c in columns])
    if (slim.count() if rows is None else rows) <= buffered:
        return _in_buffers(slim, columns, probs, by)
    found = cut_lineage(_by_narrowing(slim, columns, probs, by, buffered, accuracy))
    # A sketch states its error as relative to the rows; should a bracket have missed its
    # rank all the same, look everywhere.
    missed = found.filter((F.col("n") > 0) & F.exists("quantiles", lambda q: q.isNull()))
    if missed.limit(1).count():
        return _by_narrowing(slim, columns, probs, by, buffered, None)
    return found


def quantile_values(df: DataFrame, columns: list[str], probs: list[float],
                    rows: int | None = None,
                    buffered: int = config.MAX_BUFFERED_VALUES) -> dict[str, list[float]]:
    """Ungrouped quantiles as plain numbers, None for a column without values."""
    got = exact_quantiles(df, columns, probs, rows=rows, buffered=buffered).collect()
    found = {r["column"]: list(r["quantiles"]) for r in got if r["n"]}
    return {c: found.get(c, [None] * len(probs)) for c in columns}


def _in_buffers(df: DataFrame, columns, probs, by) -> DataFrame:
    levels = F.array(*[F.lit(float(p)) for p in probs])
    wide = df.groupBy(*by).agg(*[
        F.struct(F.lit(c).alias("column"), F.count(c).alias("n"),
                 F.percentile(c, levels).alias("quantiles")).alias(f"_{i}")
        for i, c in enumerate(columns)])
    return wide.select(*by, F.inline(F.array(*[f"_{i}" for i in range(len(columns))])))


def _brackets(df: DataFrame, columns, probs, by, accuracy: int | None) -> DataFrame:
    """(by..., column, n, slots): per level the value range its rank must lie in.

    A sketch with relative error e = 1/accuracy, asked 2e to either side, encloses it.
    Sketches merge on the map side: no value is shuffled.
    """
    def bound(c, p, side):
        level = None if accuracy is None else p + side * 2.0 / accuracy
        if level is None or not 0.0 < level < 1.0:
            return F.lit(side * float("inf"))
        return F.percentile_approx(c, level, accuracy)

    wide = df.groupBy(*by).agg(*[F.struct(
        F.lit(c).alias("column"), F.count(c).alias("n"), F.array(*[
            F.struct(F.lit(i).cast("bigint").alias("segment"), bound(c, p, -1).alias("low"),
                     bound(c, p, 1).alias("high")) for i, p in enumerate(probs)]).alias("slots")
    ).alias(f"_{i}") for i, c in enumerate(columns)])
    return wide.select(*by, F.inline(F.array(*[f"_{i}" for i in range(len(columns))])))


def _by_narrowing(df: DataFrame, columns, probs, by, buffered: int, accuracy: int | None
                  ) -> DataFrame:
    group, segment = [*by, "column"], [*by, "column", "segment"]

    def at(p):                                     # 0-based position, between two ranks
        return (F.col("n") - 1) * F.lit(float(p))

    brackets = cut_lineage(_brackets(df, columns, probs, by, accuracy))
    cells = df.select(*by, F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in columns])))
    placed = _null_safe_join(cells.filter(F.col("value").isNotNull()), brackets, group)
    below = placed.groupBy(*group).agg(F.array(*[
        F.count_if(F.col("value") < F.col("slots")[i]["low"]) for i in range(len(probs))
    ]).alias("starts"))
    inside = placed.select(*group, "value", F.explode(F.filter(
        "slots", lambda s: F.col("value").between(s["low"], s["high"]))["segment"]).alias("segment"))
    counts = inside.groupBy(*segment, "value").agg(F.count("*").alias("k"))
    ranks = F.array(*[F.array(F.floor(at(p)), F.ceil(at(p))) for p in probs])
    known = _null_safe_join(brackets.drop("slots"), below, group).withColumn("ranks", ranks)
    work = cut_lineage(_null_safe_join(counts, known, group).withColumns({
        "ranks": F.get("ranks", F.col("segment").cast("int")),
        "start": F.get("starts", F.col("segment").cast("int"))}).drop("starts"))
    while True:
        largest = work.groupBy(*segment).count().agg(F.max("count")).first()[0] or 0
        if largest <= max(buffered, _PIECES):
            break
        work = cut_lineage(_narrow(work, segment))
    running = Window.partitionBy(*segment).orderBy("value").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    hits = work.withColumn("upto", F.col("start") + F.sum("k").over(running)).select(
        *group, "value", F.explode(F.filter(
            "ranks", lambda r: (r >= F.col("upto") - F.col("k")) & (r < F.col("upto")))
        ).alias("rank"))
    picked = hits.groupBy(*group).agg(
        F.map_from_entries(F.collect_set(F.struct("rank", "value"))).alias("at"))
    values = []
    for p in probs:
        low, high = F.col("at")[F.floor(at(p))], F.col("at")[F.ceil(at(p))]
        values.append(low + (high - low) * (at(p) - F.floor(at(p))))
    return _null_safe_join(brackets.drop("slots"), picked, group, "left").select(
        *group, "n", F.array(*values).alias("quantiles"))


def _null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner"
                    ) -> DataFrame:
    """Join in which a null group matches itself.

    `right` holds a few rows per group; it is broadcast when its size allows, because the
    keys are few and shuffling the values by them would put them in few tasks.
    """
    pinned = pin_small(right)
    right = right if pinned is None else F.broadcast(pinned)
    renamed = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys],
                           *[c for c in right.columns if c not in keys])
    condition = None
    for k in keys:
        same = F.col(k).eqNullSafe(F.col(f"_r_{k}"))
        condition = same if condition is None else condition & same
    return left.join(renamed, condition, how).drop(*[f"_r_{k}" for k in keys])


def _narrow(work: DataFrame, segment: list[str]) -> DataFrame:
    """Cut each segment into pieces of similar size; keep those holding a needed rank."""
    levels = [i / _PIECES for i in range(1, _PIECES)]
    cuts = work.groupBy(*segment).agg(
        F.percentile_approx("value", levels, 10_000).alias("cuts"))
    placed = _null_safe_join(work, cuts, segment).withColumn(
        "piece", F.size(F.filter("cuts", lambda c: c < F.col("value"))))
    sizes = placed.groupBy(*segment, "piece").agg(
        F.sum("k").alias("size"), F.first("ranks").alias("ranks"),
        F.first("start").alias("start"))
    before = Window.partitionBy(*segment).orderBy("piece").rowsBetween(
        Window.unboundedPreceding, -1)
    kept = (sizes.withColumn("begin", F.col("start") + F.coalesce(
                F.sum("size").over(before), F.lit(0)))
            .filter(F.exists("ranks", lambda r: (r >= F.col("begin"))
                             & (r < F.col("begin") + F.col("size"))))
            .select(*segment, "piece", "begin"))
    joined = _null_safe_join(placed, kept, [*segment, "piece"])
    return joined.withColumns({
        "segment": F.col("segment") * _PIECES + F.col("piece"), "start": F.col("begin"),
    }).drop("piece", "begin", "cuts")
