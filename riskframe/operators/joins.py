"""Lookups and alignments by key.

A side is broadcast only after its size was looked at. Larger lookups are shuffled, and
keys that hold a large share of the rows are taken out of that shuffle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe import config

_SALTS = 4096


def pin_small(df: DataFrame, max_rows: int | None = None) -> DataFrame | None:
    """`df` as a local table when it has at most `max_rows` rows (`MAX_BROADCAST_ROWS`), else None.

    At most `max_rows + 1` rows travel to the driver. A pinned lookup is computed once,
    however often the plan uses it, and does not depend on executors staying alive.
    """
    max_rows = config.MAX_BROADCAST_ROWS if max_rows is None else max_rows
    rows = df.limit(max_rows + 1).toArrow()
    if rows.num_rows > max_rows:
        return None
    return df.sparkSession.createDataFrame(rows, df.schema)


def lookup_join(facts: DataFrame, lookup: DataFrame, on: list[str] | str,
                max_rows: int | None = None, pinned: bool = False) -> DataFrame:
    """Left lookup; `lookup` has one row per key. Null keys never match.

    `pinned` says the lookup was derived from a table `pin_small` returned.
    """
    keys = [on] if isinstance(on, str) else list(on)
    small = lookup if pinned else pin_small(lookup, max_rows)
    if small is not None:
        return facts.join(F.broadcast(small), keys, "left")
    return spread_join(facts, lookup, keys)


def spread_join(facts: DataFrame, lookup: DataFrame, keys: list[str],
                share: float | None = None) -> DataFrame:
    """Left lookup for a large lookup table and skewed facts.

    Keys with more than `share` of the rows, or more rows than a task should hold, are hot: no more
    than `MAX_BROADCAST_ROWS` can be. Their lookup rows are broadcast. Rows with such a key, or with a null key, get a random-like salt so
    that the shuffle spreads them; all other rows meet their match under salt 0.
    """
    values = [c for c in lookup.columns if c not in keys]
    total = facts.count()
    bound = min(total * (config.HOT_KEY_SHARE if share is None else share), config.TASK_ROWS)
    bound = max(1.0, bound, total / config.MAX_BROADCAST_ROWS)
    most = int(total / bound) + 1
    hot = pin_small(
        facts.groupBy(*keys).count().filter(F.col("count") > bound)
        .drop("count").na.drop(subset=keys), most)
    hot = pin_small(
        hot.join(lookup, keys, "left").select(
            *keys, F.lit(True).alias("_hot"), *[F.col(v).alias(f"_hot_{v}") for v in values]),
        most)
    no_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    salted = facts.join(F.broadcast(hot), keys, "left").withColumn(
        "_salt", F.when(
            F.col("_hot").isNotNull() | no_key,
            1 + F.pmod(F.xxhash64(*[F.col(c) for c in facts.columns]), F.lit(_SALTS))
        ).otherwise(F.lit(0)).cast("bigint"))
    # pmod by 1 is always 0 but keeps the salt a join key the optimizer cannot fold away.
    right = lookup.withColumn("_salt", F.pmod(F.xxhash64(*keys), F.lit(1)).cast("bigint"))
    joined = salted.join(right, keys + ["_salt"], "left")
    return joined.select(
        *[F.col(c) for c in facts.columns],
        *[F.when(F.col("_hot").isNotNull(), F.col(f"_hot_{v}")).otherwise(F.col(v)).alias(v)
          for v in values])


def lookup_with_default(facts: DataFrame, lookup: DataFrame, on: str, value: str,
                        default, alias: str) -> DataFrame:
    """Value for the key; missing key, null key and null value all take `default`."""
    named = lookup.select(F.col(on), F.col(value).alias(alias))
    joined = lookup_join(facts, named, on)
    return joined.withColumn(alias, F.coalesce(F.col(alias), F.lit(default)))


def keep_known(facts: DataFrame, vocabulary: DataFrame, on: str) -> DataFrame:
    """Rows whose key is in the vocabulary."""
    return facts.join(_hinted(vocabulary.select(on)), on, "left_semi")


def keep_unknown(facts: DataFrame, vocabulary: DataFrame, on: str) -> DataFrame:
    """Rows whose key is not in the vocabulary, null keys included."""
    return facts.join(_hinted(vocabulary.select(on)), on, "left_anti")


def _hinted(small_or_large: DataFrame) -> DataFrame:
    pinned = pin_small(small_or_large.distinct())
    return small_or_large.distinct() if pinned is None else F.broadcast(pinned)


def align_models(predictions: DataFrame, models: list[str], keys=(config.ID,),
                 model: str = "model", value: str = "prediction") -> DataFrame:
    """Long predictions to one row per id with a column per model, in one shuffle."""
    return predictions.groupBy(*keys).agg(*[
        F.avg(F.when(F.col(model) == m, F.col(value))).alias(m) for m in models])
