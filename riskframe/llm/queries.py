"""The queries of the subpackage, one per numbered operator; each reads its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.llm.align import align_tokenizers
from riskframe.llm.bpe import encode_and_decode
from riskframe.llm.chat import format_examples, read_back
from riskframe.llm.exact import exact_duplicates
from riskframe.llm.licences import licence_scan
from riskframe.llm.lines import dedup_lines
from riskframe.llm.merkle import manifest
from riskframe.llm.neardup import near_duplicates
from riskframe.llm.packing import pack_documents
from riskframe.llm.quality import quality_rules
from riskframe.llm.secrets import secret_spans, span_list
from riskframe.llm.simhash import simhash_groups
from riskframe.llm.text import lower_ascii
from riskframe.llm.urls import filter_urls

# --- fixed values: what the queries apply their operators to ----------------
PROBE_ID, PROBE_TEXT = -7, r"\### Assistant: </turn> ok"
URL_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"),
             ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"),
             ("net", "/fr/", "block")]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_chat_examples(spark: SparkSession, folder: str) -> DataFrame:
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame(
        [(PROBE_ID, 0, "user", PROBE_TEXT), (PROBE_ID, 1, "assistant", PROBE_TEXT)], turns.schema)
    return read_back(format_examples(turns.unionByName(probe)))


def op2_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op3_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_duplicates(table(spark, folder, "documents"))


def op4_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    rows = dedup_lines(table(spark, folder, "documents"))
    text = F.coalesce("text", F.lit(""))
    return rows.select("doc_id", F.col("__n_lines").alias("n_lines"),
                       F.col("__n_dropped").alias("n_dropped"),
                       F.length(text).cast("long").alias("kept_chars"),
                       F.sha2(text, 256).alias("text_sha256"))


def op5_licence_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licence_scan(table(spark, folder, "documents"))


def op6_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    """Pages are labelled by the labels of their number: bad where quality is 0 or toxic is 1."""
    pages = table(spark, folder, "pages").select("page_id", "url")
    labels = table(spark, folder, "labels").groupBy(F.col("doc_id").alias("page_id")).agg(
        F.max((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("bad"))
    return filter_urls(pages, pages.join(labels, "page_id"), URL_RULES).drop("mined")


def op7_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = secret_spans(table(spark, folder, "documents"))
    counted = [F.size(F.filter("base", lambda s, k=k: s["kind"] == k)).cast("long").alias(name)
               for k, name in enumerate(["n_assign", "n_access", "n_hex"])]
    return found.select("doc_id", *counted, F.sha2(span_list(F.col("base")), 256).alias(
        "base_sha256"), span_list(F.col("spans")).alias("spans"))


def op8_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack_documents(table(spark, folder, "documents"),
                          public_tokenizers.path("word_bpe_49k.json"))


def op9_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents"))


def op10_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    coded = encode_and_decode(table(spark, folder, "documents"),
                              public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


def op11_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """In the tampered table every third document, by a checksum of its id, is in lower case."""
    text = F.col("text")
    hit = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    return manifest(table(spark, folder, "documents"), found={
        "text": F.when(hit, lower_ascii(text)).otherwise(text)}).drop("path")


def op12_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash_groups(table(spark, folder, "documents"))


def op13_tokenizer_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return align_tokenizers(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                            public_tokenizers.path("piece_bpe_32k.model"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_chat_examples": op1_chat_examples,
    "op2_quality_rules": op2_quality_rules,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_line_dedup": op4_line_dedup,
    "op5_licence_scan": op5_licence_scan,
    "op6_url_filter": op6_url_filter,
    "op7_secret_scan": op7_secret_scan,
    "op8_best_fit_packing": op8_best_fit_packing,
    "op9_near_duplicates": op9_near_duplicates,
    "op10_byte_bpe": op10_byte_bpe,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_simhash": op12_simhash,
    "op13_tokenizer_alignment": op13_tokenizer_alignment,
}
