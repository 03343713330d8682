"""Cleaning expressions; every one keeps missing as null, never NaN."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe import config

# Fixed value: what counts as a number in text, surrounding blanks aside.
DECIMAL_TEXT = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def is_decimal_text(text: Column) -> Column:
    return text.rlike(DECIMAL_TEXT)


def to_number(column: Column) -> Column:
    """Text to double; anything that is not a plain number becomes null.

    The pattern guards the cast: a bare `try_cast` would read '7d' as 7.0.
    """
    text = F.trim(column.cast("string"))
    return F.when(is_decimal_text(text), text.try_cast("double"))


def nan_to_null(column: Column) -> Column:
    return F.when(~F.isnan(column), column)


def clean_nan(df: DataFrame) -> DataFrame:
    """NaN in floating columns becomes null, so that missing is null everywhere after entry."""
    return df.withColumns({f.name: nan_to_null(F.col(f.name)) for f in df.schema
                           if isinstance(f.dataType, (T.DoubleType, T.FloatType))})


def is_numeric(kind: T.DataType) -> bool:
    return isinstance(kind, (T.NumericType, T.BooleanType))


def coerce_numeric(df: DataFrame, columns=config.DIRTY_NUMERIC) -> DataFrame:
    """Dirty number columns to double, absent columns ignored."""
    return df.withColumns({c: to_number(F.col(c)) for c in columns if c in df.columns})


def add_missing_flags(df: DataFrame, columns=config.MISSING_FLAG_COLUMNS,
                      suffix: str = "_missing") -> DataFrame:
    """0/1 column per source column. Apply before anything is filled."""
    return df.withColumns(
        {f"{c}{suffix}": F.col(c).isNull().cast("int") for c in columns if c in df.columns})


def fill_constants(df: DataFrame, fills: dict[str, float]) -> DataFrame:
    return df.withColumns(
        {c: F.coalesce(F.col(c), F.lit(v)) for c, v in fills.items() if c in df.columns})


def below(column: Column, limit: float, missing: float) -> Column:
    """1 when the value, missing ones filled, lies under `limit`."""
    return (F.coalesce(column, F.lit(missing)) < F.lit(limit)).cast("int")


def above(column: Column, limit: float) -> Column:
    return (column > F.lit(limit)).cast("int")


def category_text(column: Column) -> Column:
    """Category as text; missing is a category of its own."""
    return F.coalesce(column.cast("string"), F.lit(config.MISSING_LABEL))


def replace_unseen(column: Column, known: Column, label: str = config.UNSEEN_LABEL) -> Column:
    """The value where `known` matched, the sentinel elsewhere."""
    return F.when(known.isNotNull(), column).otherwise(F.lit(label))


def add_casts(df: DataFrame, doubles=(), texts=()) -> DataFrame:
    kinds = {c: F.col(c).cast("double") for c in doubles if c in df.columns}
    kinds.update({c: F.col(c).cast("string") for c in texts if c in df.columns})
    return df.withColumns(kinds)
