"""A pipeline over documents: quality, repeated lines, near duplicates, secrets, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written and read again as
the next stage's documents. All but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.llm.lines import dedup_lines
from riskframe.llm.neardup import keep_one
from riskframe.llm.packing import pack_documents
from riskframe.llm.quality import keep_good
from riskframe.llm.secrets import mask_secrets
from riskframe.llm.text import NOT_BLANK
from riskframe.session import cut_lineage

ORACLE_SQL = None
WORD_BYTES = 25_000_000   # of words a worker remembers when it packs


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules; the others go."""
    return keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without repeated lines. One that loses all its words has nothing that does not
    stand elsewhere, and goes; n_chars follows the text."""
    rows = dedup_lines(docs).filter(
        (F.col("__n_dropped") == 0) | F.col("text").rlike(NOT_BLANK))
    return rows.withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that of the smallest id."""
    return keep_one(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets masked; n_chars follows the text."""
    return mask_secrets(docs).withColumn("n_chars", F.length("text").cast("long"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences. Workers that served the stages before
    still hold memory, so they remember fewer words."""
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), cache_bytes=WORD_BYTES)


STAGES = [("quality rules", quality), ("line dedup", lines), ("near duplicates", near_duplicates),
          ("secret scan", secrets), ("best-fit packing", packing)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of `sf_dir`; what lies between them is written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
