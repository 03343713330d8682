"""Delimited files: typed scan with missing tokens, templates, prediction sinks."""

from __future__ import annotations

import re
from functools import reduce
from typing import NamedTuple
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe import config
from riskframe.functions.cleaning import is_decimal_text


def missing_tokens_to_null(column):
    """A cell equal to one of the missing tokens, as it stands, becomes null."""
    return F.when(~column.isin(config.NA_TOKENS), column)


class FileGroup(NamedTuple):
    """Files of one header line that are read alike."""

    paths: list[str]
    multi_line: bool


def survey_files(spark: SparkSession, path: str | list[str], multi_line: bool | None = None) -> list[FileGroup]:
    """The files below `path` by their header line and by whether they may be split.

    One pass over the lines as plain text, which Spark splits. A field that holds a line break
    leaves a line with an odd number of quotes, so files in which every line has an even number
    are read in splits; `multi_line` overrules what was found. Only file names and header lines
    reach the driver, as they do in Spark's own listing.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("place"), "value")
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    odd = quotes % 2 == 1
    files = lines.groupBy("path").agg(
        # Lines of a split follow each other.
        F.min_by("value", F.when(F.col("start") == 0, F.col("place"))).alias("header"),
        F.bool_or(odd).alias("broken"))
    found: dict[tuple, list[str]] = {}
    for row in files.sort("path").toLocalIterator():
        broken = row["broken"] if multi_line is None else multi_line
        # A header that goes on in the next line is only known once it is parsed.
        own = row["path"] if row["header"].count('"') % 2 else ""
        found.setdefault((row["header"], broken, own), []).append(_as_path(row["path"]))
    return [FileGroup(paths, broken) for (_, broken, _), paths in found.items()]


def _as_path(uri: str) -> str:
    """The path of a file's URI, with what would be a pattern escaped."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", unquote(uri))


def _group_cells(spark: SparkSession, group: FileGroup) -> DataFrame:
    return spark.read.csv(group.paths, header=True, inferSchema=False, quote='"', escape='"',
                          multiLine=group.multi_line, ignoreLeadingWhiteSpace=False,
                          ignoreTrailingWhiteSpace=False)


def _cells(spark: SparkSession, path: str | list[str], multi_line: bool | None = None) -> DataFrame:
    """All cells as text under the header's own names; a doubled quote is a quote.

    Every file is read by its own header, whatever the order of its columns; a column that some
    files lack is null in their rows. An empty folder has no columns.
    """
    groups = [_group_cells(spark, group) for group in survey_files(spark, path, multi_line)]
    if not groups:
        return spark.createDataFrame([], T.StructType([]))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), groups)


def read_csv(spark: SparkSession, path: str | list[str], schema: T.StructType,
             multi_line: bool | None = None) -> DataFrame:
    """Scan as text, normalise missing tokens, then cast to `schema`.

    `path` is a file, a folder or a list of them. Columns are found by the header's names, in any
    order and file by file; other columns are left out and one that no file has is an error.

    A declared schema spares the extra pass type inference costs, and reading text
    first keeps `NA` or `NaN` cells from turning a number column into text or NaN.
    """
    return _declared(_cells(spark, path, multi_line), schema, path)


def _declared(cells: DataFrame, schema: T.StructType, path: str | list[str]) -> DataFrame:
    absent = [f.name for f in schema if f.name not in cells.columns]
    if absent:
        raise ValueError(f"{path} has no column {', '.join(absent)}")
    return cells.select(*[_typed(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in schema])


def _typed(column, kind: T.DataType):
    text = missing_tokens_to_null(column)
    if isinstance(kind, T.StringType):
        return text
    text = F.trim(text)
    if isinstance(kind, T.NumericType):
        text = F.when(is_decimal_text(text), text)   # a bare cast reads '7d' as 7.0
    return text.try_cast(kind)


def infer_schema(spark: SparkSession, path: str | list[str], multi_line: bool | None = None) -> T.StructType:
    """Column types from the files: long, double or string, in one aggregation.

    A column is numeric when every cell that is not a missing token is a number.
    """
    return _inferred(_cells(spark, path, multi_line))


def _inferred(raw: DataFrame) -> T.StructType:
    checks = []
    for i, name in enumerate(raw.columns):
        text = missing_tokens_to_null(F.col(f"`{name}`"))
        cell = F.trim(text)
        checks += [
            F.coalesce(F.bool_and(is_decimal_text(cell)), F.lit(True)).alias(f"n{i}"),
            F.coalesce(F.bool_and(cell.rlike(r"^[+-]?\d{1,18}$")), F.lit(False)).alias(f"i{i}"),
            F.coalesce(F.bool_or(cell.isNull()), F.lit(False)).alias(f"m{i}"),
        ]
    found = raw.agg(*checks).first() if checks else {}
    fields = []
    for i, name in enumerate(raw.columns):
        if not found[f"n{i}"]:
            kind = T.StringType()
        elif found[f"i{i}"] and not found[f"m{i}"]:
            kind = T.LongType()
        else:
            kind = T.DoubleType()
        fields.append(T.StructField(name, kind))
    return T.StructType(fields)


def shared_schema(*schemas: T.StructType) -> T.StructType:
    """One type per column over several files: text beats double beats long."""
    order = [T.LongType(), T.DoubleType(), T.StringType()]
    kinds: dict[str, T.DataType] = {}
    for field in (f for schema in schemas for f in schema):
        both = [field.dataType, kinds.get(field.name, field.dataType)]
        kinds[field.name] = max(both, key=order.index)
    return T.StructType([T.StructField(name, kind) for name, kind in kinds.items()])


def load_pair(spark: SparkSession, train_path: str | list[str], test_path: str | list[str],
              schema: T.StructType | None = None, multi_line: bool | None = None) -> DataFrame:
    """Train and test files as one table with a `split` column; test has no target.

    Without a declared schema both files are looked at, and a column that is text in either is
    text in both, so that coercion sees the strays of the test file too.
    """
    from riskframe.operators.rows import union_splits

    paths = (train_path, test_path)
    sides = [_cells(spark, path, multi_line) for path in paths]
    if schema is None:
        schema = shared_schema(*map(_inferred, sides))
    frames = [_declared(side, T.StructType([f for f in schema if f.name in side.columns]), path)
              for side, path in zip(sides, paths, strict=True)]
    return union_splits(*frames)


def read_template(spark: SparkSession, path: str, id_col: str = config.ID,
                  target: str = config.TARGET, multi_line: bool | None = None) -> DataFrame:
    """Ids the output must hold, with the placeholder target."""
    return read_csv(spark, path, T.StructType([
        T.StructField(id_col, T.LongType()), T.StructField(target, T.DoubleType())]), multi_line)


def fill_template(template: DataFrame, predictions: DataFrame, id_col: str = config.ID,
                  target: str = config.TARGET) -> DataFrame:
    """The template's ids with predicted targets, matched by id instead of position."""
    return template.drop(target).join(predictions.select(id_col, target), id_col, "left")


def write_predictions(predictions: DataFrame, path: str, id_col: str = config.ID,
                      target: str = config.TARGET, mode: str = "errorifexists") -> None:
    """Two columns with header; one part file per partition, never merged into one."""
    from riskframe.functions.features import clip_unit

    predictions.select(id_col, clip_unit(F.col(target)).alias(target)).write.mode(mode).csv(
        path, header=True)


def write_variants(predictions: DataFrame, variants: dict[str, str], path: str,
                   id_col: str = config.ID, target: str = config.TARGET,
                   mode: str = "errorifexists") -> None:
    """Several versions of one prediction set in a single pass, split by `variant`."""
    from riskframe.functions.features import clip_unit

    versions = F.array(*[
        F.struct(F.lit(name).alias("variant"), clip_unit(F.col(column)).alias(target))
        for name, column in variants.items()])
    (predictions.select(id_col, F.inline(versions))
        .write.mode(mode).partitionBy("variant").csv(path, header=True))
