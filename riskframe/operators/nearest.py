"""The nearest of any number of centres, by a search down a pyramid of cells.

The centres' square is halved in both directions, level by level, until a cell holds `LEAF` centres or
fewer. A point starts with the whole square and keeps the cells that may hold its nearest centre: those
not farther than the nearest centre that the box of some cell is sure to hold. A level is one equi-join
of the kept cells with their parts; the centres of the last cells are compared one by one.

A point keeps a handful of cells on each level, whether centres are spread evenly or crowd in one place,
so the work is the number of distinct points times the logarithm of the number of centres.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.operators.joins import lookup_join, pin_small
from riskframe.operators.spatial import nearest_centroid
from riskframe.session import cut_lineage

LEAF = 8               # centres a cell may hold before it is cut
DEPTH = 26             # levels of halving at most
FEW_CENTRES = 256      # so many are part of the expression, without a search
SMALL_LEVELS = 8       # levels of at most 4**8 cells, whose parts are broadcast


def _apart(x: Column, low: Column, high: Column) -> Column:
    return F.greatest(F.lit(0.0), low - x, x - high)


def _bounds(x: Column, y: Column, box: Column) -> tuple[Column, Column]:
    """Squared distances: no centre of the box is nearer, one is not farther. Each side of the box
    has a centre on it."""
    dx, dy = _apart(x, box["x0"], box["x1"]), _apart(y, box["y0"], box["y1"])
    near_x, near_y = (F.least(F.abs(v - box[f"{n}0"]), F.abs(v - box[f"{n}1"])) for v, n in ((x, "x"), (y, "y")))
    far_x, far_y = (F.greatest(F.abs(v - box[f"{n}0"]), F.abs(v - box[f"{n}1"])) for v, n in ((x, "x"), (y, "y")))
    return dx * dx + dy * dy, F.least(near_x * near_x + far_y * far_y, near_y * near_y + far_x * far_x)


def _at(name: str, level: Column) -> Column:
    """A centre's cell number on a level, from that on the deepest one."""
    return F.expr(f"shiftright({name}, {DEPTH} - {level})")


def _pyramid(centres: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """(parts, ends, levels) of (x, y, label): the parts of each cut cell, the centres of each last
    cell, and the number of levels on which cells are cut."""
    low = centres.agg(F.min("x"), F.min("y"), F.greatest(F.max("x") - F.min("x"), F.max("y") - F.min("y"))).first()
    side = (low[2] or 0.0) * (1 + 1e-9) or 1.0
    cells = centres.select("x", "y", "label", *[
        F.least(F.floor((F.col(c) - F.lit(float(low[i] or 0.0))) / side * 2.0 ** DEPTH), F.lit(2 ** DEPTH - 1)).cast(
            "long").alias(f"i{c}") for i, c in enumerate("xy")])
    # Counts of the cells of all levels in one pass.
    every = cells.select("x", "y", "ix", "iy", F.explode(F.sequence(F.lit(0), F.lit(DEPTH))).alias("level"))
    counted = cut_lineage(every.groupBy("level", _at("ix", "level").alias("cx"), _at("iy", "level").alias("cy")).agg(
        F.count(F.lit(1)).alias("n"), F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"),
        F.max("y").alias("y1")))
    cut = cut_lineage(counted.filter((F.col("n") > LEAF) & (F.col("level") < DEPTH)).select("level", "cx", "cy"))
    levels = (cut.agg(F.max("level")).first()[0] or 0) + 1 if not cut.isEmpty() else 0
    below = counted.select((F.col("level") - 1).alias("level"), F.shiftright("cx", 1).alias("px"), F.shiftright(
        "cy", 1).alias("py"), F.struct("cx", "cy", "n", "x0", "x1", "y0", "y1").alias("part"))
    parents = cut.select("level", F.col("cx").alias("px"), F.col("cy").alias("py"))
    parts = cut_lineage(below.join(parents, ["level", "px", "py"]).groupBy("level", "px", "py").agg(
        F.collect_list("part").alias("parts")))
    # A centre's last cell lies one level below the deepest cut cell that holds it.
    deepest = cells.select("x", "y", "label", "ix", "iy", F.explode(F.sequence(F.lit(0), F.lit(DEPTH))).alias(
        "level")).withColumns({"cx": _at("ix", "level"), "cy": _at("iy", "level")}).join(
        cut, ["level", "cx", "cy"]).groupBy("x", "y").agg(F.max("level").alias("level"))
    placed = cells.join(deepest, ["x", "y"], "left").withColumn("level", F.coalesce(F.col("level") + 1, F.lit(0)))
    ends = cut_lineage(placed.groupBy("level", _at("ix", "level").alias("cx"), _at("iy", "level").alias("cy")).agg(
        F.collect_list(F.struct("x", "y", "label")).alias("centres")))
    return parts, ends, levels


def _bounded(x: Column, y: Column, level: int) -> Callable[[Column], Column]:
    """What a point keeps of a cell of `level`."""
    def kept(part: Column) -> Column:
        low, high = _bounds(x, y, part)
        return F.struct(F.lit(level).alias("level"), part["cx"].alias("cx"), part["cy"].alias("cy"), low.alias("low"),
                        high.alias("high"), (part["n"] > LEAF).alias("open"))
    return kept


def nearest_of_table(df: DataFrame, columns: list[str], centres: DataFrame, label: str,
                     name: str = "centroid") -> DataFrame:
    """`df` with the label of the closest row of `centres` (label, *columns), the lower label on ties.

    Distances are straight lines in the two columns. A row with a missing coordinate gets null, as all
    do when there are no centres; centres with a missing coordinate or label are left out.
    """
    a, b = columns
    spots = centres.select(F.col(a).cast("double").alias("x"), F.col(b).cast("double").alias("y"), F.col(label).alias("label"))
    spots = cut_lineage(spots.na.drop().groupBy("x", "y").agg(F.min("label").alias("label")))
    few = pin_small(spots, FEW_CENTRES)
    if few is not None:
        written_out = [(r["label"], r["x"], r["y"]) for r in few.collect()]
        if written_out:
            return nearest_centroid(df, columns, written_out, name)
    parts, ends, levels = _pyramid(spots)
    x, y = F.col("x"), F.col("y")
    points = df.select(F.col(a).cast("double").alias("x"), F.col(b).cast("double").alias("y")).na.drop().distinct()
    kept = points.select("x", "y", F.lit(0).alias("level"), F.lit(0).cast("long").alias("cx"), F.lit(0).cast(
        "long").alias("cy"), F.lit(0.0).alias("low"), F.lit(None).cast("double").alias("high"), F.lit(True).alias("open"))
    for level in range(levels):
        mine = parts.filter(F.col("level") == level).select(
            F.col("px").alias("cx"), F.col("py").alias("cy"), F.lit(True).alias("open"), "parts")
        if level <= SMALL_LEVELS:
            mine = F.broadcast(mine)
        # Cells that were not cut stay as they are.
        found = kept.join(mine, ["cx", "cy", "open"], "left")
        same = F.array(F.struct(F.col("level"), F.col("cx"), F.col("cy"), F.col("low"), F.col("high"), F.lit(False).alias("open")))

        found = found.select("x", "y", F.explode(F.when(F.col("parts").isNotNull(), F.transform(
            "parts", _bounded(x, y, level + 1))).otherwise(same)).alias("c")).groupBy("x", "y").agg(F.collect_list("c").alias("c"), F.min("c.high").alias("best"))
        kept = found.select("x", "y", F.explode(F.filter("c", lambda c: c["low"] * (1 - 1e-12) <= F.col("best"))).alias(
            "c")).select("x", "y", "c.*")
    near = kept.join(ends, ["level", "cx", "cy"]).select("x", "y", F.array_min(F.transform("centres", lambda c: F.struct(
        ((x - c["x"]) * (x - c["x"]) + (y - c["y"]) * (y - c["y"])).alias("d"), c["label"].alias("label")))).alias("m"))
    best = cut_lineage(near.groupBy("x", "y").agg(F.min("m").alias("m")).select("x", "y", F.col("m.label").alias(name)))
    keyed = df.withColumns({"_x": F.col(a).cast("double"), "_y": F.col(b).cast("double")})
    return lookup_join(keyed, best.withColumnsRenamed({"x": "_x", "y": "_y"}), ["_x", "_y"]).drop("_x", "_y")
