"""Column choice by profile and by type."""

from __future__ import annotations

from pyspark.sql import DataFrame

from riskframe import config
from riskframe.functions.cleaning import is_numeric


def drop_profile(df: DataFrame, profile: str = "core") -> DataFrame:
    """Remove the profile's columns; those absent are ignored."""
    return df.drop(*config.DROP_PROFILES[profile])


def feature_columns(train: DataFrame, test: DataFrame | None = None,
                    profile: str = "core", extra_drop=()) -> list[str]:
    """Train columns left by the profile and, when `test` is given, present there too."""
    out = {*config.DROP_PROFILES[profile], *extra_drop, config.SPLIT}
    present = set(train.columns if test is None else test.columns)
    return [c for c in train.columns if c not in out and c in present]


def split_kinds(df: DataFrame, columns=None) -> tuple[list[str], list[str]]:
    """(numeric, categorical) names by schema type; booleans count as numeric."""
    names = list(columns) if columns is not None else df.columns
    numeric = [c for c in names if is_numeric(df.schema[c].dataType)]
    return numeric, [c for c in names if c not in numeric]
