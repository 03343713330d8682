"""Session settings and the shared folders a job may write to."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager, nullcontext
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
    "spark.ui.enabled": "false",
    # Longer generated methods are not compiled; the operators run one by one instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}
TASK_ROWS = 20_000        # rows a task must have before a table is spread over more
METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"


def build_session(app: str = "riskframe", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution on. `conf` keys use `__` for `.`."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by `spark.checkpoint.dir`.

    Where that is unset, a folder inside the warehouse, which all executors share as well.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder; nothing is overwritten."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """`df` written once to the shared folder and read back.

    Later stages do not recompute it when executors are lost, and the planner sees its real
    size, which a checkpointed plan hides.
    """
    return written(df)[0]


def written(df: DataFrame) -> tuple[DataFrame, str]:
    """`df` written to the shared folder and read back, and its path for `remove`."""
    path = scratch_path(df.sparkSession, "cut")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


@contextmanager
def held(df: DataFrame) -> Iterator[DataFrame]:
    """`df` written to the shared folder and read back while the block lasts.

    What reads it plans a read of files, not all that led to it.
    """
    table, path = written(df)
    try:
        yield table
    finally:
        remove(df.sparkSession, path)


@contextmanager
def short_methods(spark: SparkSession) -> Iterator[None]:
    """The limit of `DEFAULTS` on generated methods, also in a session that was not built here.

    The JVM interprets methods above it, which makes a wide table of features several times dearer.
    The session's own value is set again afterwards.
    """
    before = spark.conf.get(METHOD_LIMIT)
    spark.conf.set(METHOD_LIMIT, DEFAULTS[METHOD_LIMIT])
    try:
        yield
    finally:
        spark.conf.set(METHOD_LIMIT, before)


def spread(table: DataFrame) -> DataFrame:
    """A written table in two tasks a core, where its files give fewer and they would have more than
    `TASK_ROWS` rows each."""
    want = min(2 * table.sparkSession.sparkContext.defaultParallelism, table.count() // TASK_ROWS)
    return table.repartition(want) if table.rdd.getNumPartitions() < want else table


def training_run(run: Callable) -> Callable:
    """`run(df, ...)` over `df` written once, since its steps read it a dozen times.

    What `run` returns must not read `df` any more.
    """
    @wraps(run)
    def prepared(df: DataFrame, *args, **named):
        with short_methods(df.sparkSession), held(df) as table:
            dealt = spread(table)
            with nullcontext(table) if dealt is table else held(dealt) as table:
                return run(table, *args, **named)
    return prepared


def remove(spark: SparkSession, path: str) -> None:
    """Delete a table of `written` that nothing reads any more."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
