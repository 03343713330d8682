"""Fold assignment and fold views."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe import config
from riskframe.functions.cleaning import category_text
from riskframe.functions.hashing import hash_bucket
from riskframe.operators.encode import rank_categories
from riskframe.operators.joins import lookup_join
from riskframe.operators.rows import train_rows
from riskframe.session import cut_lineage


def kfold(df: DataFrame, k: int = config.N_FOLDS, seed: int = config.SEED,
          id_col: str = config.ID, name: str = "fold") -> DataFrame:
    """Shuffled folds from the id alone: no shuffle, same fold wherever the row is."""
    return df.withColumn(name, hash_bucket(F.col(id_col), seed, k))


def group_sizes(df: DataFrame, group: Column) -> DataFrame:
    return df.groupBy(category_text(group).alias("group")).agg(F.count("*").alias("size"))


def greedy_segments(counts: list[tuple[int, int]], k: int) -> list[tuple[int, int, int, list[int]]]:
    """(size, first rank, ranks, cycle of folds) of the greedy rule over (size, groups of it).

    Groups go largest first, each to the fold of least (load, number). Groups of one size are
    interchangeable, so the folds in reach take turns in a fixed order until their loads reach
    the next fold, which then joins in: at most k segments a size, however many groups it has.
    """
    loads = [(0, f) for f in range(k)]
    segments = []
    for size, groups in sorted(counts, reverse=True):
        rest = sorted(loads)
        turns = [rest.pop(0)]
        done = 0
        while done < groups:
            picks = groups - done
            if rest:
                load, fold = rest[0]
                reach = 0
                for mine, f in turns:
                    if (mine, f) < (load, fold):
                        whole, left = divmod(load - mine, size)
                        reach += whole + (left > 0 or f < fold)
                picks = min(picks, reach)
            if picks:
                segments.append((size, done, picks, [f for _, f in turns]))
                whole, left = divmod(picks, len(turns))
                turns = sorted((mine + size * (whole + (i < left)), f)
                               for i, (mine, f) in enumerate(turns))
                done += picks
            if done < groups:
                turns = sorted([*turns, rest.pop(0)])
        loads = [*turns, *rest]
    return segments


def assign_groups(sizes: DataFrame, k: int = config.N_FOLDS) -> DataFrame:
    """(group, fold): the largest group first, each to the fold with least rows so far.

    Only the number of groups of each size reaches the driver, at most the square root of twice
    the rows; a group's fold follows from its rank among the groups of its size.
    """
    sizes = cut_lineage(sizes.select("size", F.col("group").alias("category")))
    counts = [(r["size"], r["groups"]) for r in sizes.groupBy("size").agg(
        F.count("*").alias("groups")).collect()]
    total = sum(n for _, n in counts)
    if total < k:
        raise ValueError(f"{total} groups cannot fill {k} folds")
    segments = sizes.sparkSession.createDataFrame(
        greedy_segments(counts, k), "size long, first long, ranks long, cycle array<int>")
    at = F.col("code") - F.col("first")
    return rank_categories(sizes, ["size"]).join(segments, "size").filter(
        (at >= 0) & (at < F.col("ranks"))).select(
        F.col("category").alias("group"), F.get("cycle", F.pmod(at, F.size("cycle")).cast("int")).alias("fold"))


def group_kfold(df: DataFrame, group: str, k: int = config.N_FOLDS, name: str = "fold",
                fitted_on: DataFrame | None = None) -> DataFrame:
    """Folds that keep each group together; a missing group label is a group.

    With `fitted_on`, sizes are counted there, and a group it lacks gets no fold.
    """
    source = df if fitted_on is None else fitted_on
    folds = assign_groups(group_sizes(source, F.col(group)), k).select(
        F.col("group").alias("_group"), F.col("fold").alias(name))
    return lookup_join(df.withColumn("_group", category_text(F.col(group))), folds, "_group"
                       ).drop("_group")


def fold_train_rows(df: DataFrame, group: str, k: int = config.N_FOLDS, name: str = "fold") -> DataFrame:
    """Group folds of the train rows; test rows have none. No join of the table with itself."""
    made = group_kfold(df, group, k, name, train_rows(df))
    return made.withColumn(name, F.when(F.col(config.SPLIT) == config.TRAIN, F.col(name)))


def training_view(df: DataFrame, fold: int, name: str = "fold") -> DataFrame:
    return df.filter(F.col(name) != fold)


def validation_view(df: DataFrame, fold: int, name: str = "fold") -> DataFrame:
    return df.filter(F.col(name) == fold)


def fold_sizes(df: DataFrame, value: str = config.TARGET, name: str = "fold") -> DataFrame:
    """(fold, side, rows, value_sum) of the training and validation view of every fold, from one
    scan: a training view is everything less the fold."""
    own = df.filter(F.col(name).isNotNull()).groupBy(name).agg(
        F.count("*").alias("n"), F.sum(value).alias("v"))
    every = Window.partitionBy(F.lit(0))          # one row a fold
    own = own.select("*", F.sum("n").over(every).alias("all_n"), F.sum("v").over(every).alias("all_v"))
    return own.select(name, F.inline(F.array(
        F.struct(F.lit("valid").alias("side"), F.col("n").alias("rows"), F.col("v").alias("value_sum")),
        F.struct(F.lit("train").alias("side"), (F.col("all_n") - F.col("n")).alias("rows"),
                 (F.col("all_v") - F.col("v")).alias("value_sum")))))
