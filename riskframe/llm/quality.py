"""Quality rules and a hashed n-gram likelihood ratio, in DataFrame operations only.

Every document gets plain counts (words, symbols, repeated lines, words in repeated windows) and
the verdict of two multinomials over hashed n-grams: one of trusted documents, one of all. The
score is the mean log-likelihood ratio of its words and word pairs; it does not grow with length.
All trusted documents set the weights, and all set the threshold: by their scores under the weights
of the other folds.

Nothing is shuffled but bucket counts: n-grams are hashed inside the row, combined per task, and
a task sends at most `BUCKETS` counts. Weights are whole numbers (millionths), so that a sum does
not depend on the order of its terms.
"""

from __future__ import annotations

import math
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from riskframe.llm.text import NOT_BLANK, filled, lines_of, words_of
from riskframe.operators.joins import lookup_join, pin_small
from riskframe.operators.quantiles import quantile_values
from riskframe.session import cut_lineage

BUCKETS = 16_384          # hashed n-gram buckets, a power of two
SCALE = 1_000_000         # weights are whole millionths
MAX_BITMAPS = 4_096       # of 32,768 ids and 4 KB each, broadcast where trusted ids are too many
FOLDS = 5                 # of trusted rows, each scored by weights of the others for the threshold
CUT_SHARE = 0.002         # share of the trusted rows that may lie below the threshold
CUT_MARGIN = 0.05         # and the distance kept from it
WINDOW = 8                # words of a window that counts as repeated
MIN_WORDS = 20
MAX_REPEATED_PERCENT = 30
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
SYMBOLS = r"[#*$%&|<>]"


def counted(docs: DataFrame, text_col: str) -> DataFrame:
    """The columns of the table in `__row`, with n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, and `__low`, the hashes of the lower-cased words.

    A window of eight words counts as repeated when it occurs at two places or more of the text;
    n_repeat_words is the number of words that lie in such windows.
    """
    text = F.col("__text")
    rows = docs.select(F.struct(*map(F.col, docs.columns)).alias("__row"), filled(F.col(text_col)).alias("__text"))
    rows = rows.select(
        "__row", "__text", words_of(text).alias("__words"), words_of(F.lower(text)).alias("__lower"),
        F.filter(lines_of(text), lambda line: line.rlike(NOT_BLANK)).alias("__lines"))
    rows = rows.select(
        "__row", F.size("__words").cast("long").alias("n_words"),
        F.length(F.array_join("__words", "")).cast("long").alias("word_chars"),
        F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        F.transform("__words", lambda word: F.xxhash64(word)).alias("__hash"),
        F.transform("__lower", lambda word: F.xxhash64(word)).alias("__low"))
    starts = F.sequence(F.lit(1), F.size("__hash") - (WINDOW - 1))
    windows = F.when(F.size("__hash") >= WINDOW, F.transform(
        starts, lambda i: F.xxhash64(F.slice("__hash", i, F.lit(WINDOW)))))
    rows = rows.withColumn("__windows", windows)
    # Most texts have no window twice; only the others are sorted.
    rows = rows.withColumn("__sorted", F.when(
        F.size(F.array_distinct("__windows")) < F.size("__windows"),
        F.sort_array(F.transform("__windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    around = F.col("__sorted")
    twice = F.filter(around, lambda x, k: (F.get(around, k - 1)["h"].eqNullSafe(x["h"]))
                     | (F.get(around, k + 1)["h"].eqNullSafe(x["h"])))
    rows = rows.withColumn("__twice", F.sort_array(F.transform(twice, lambda x: x["i"])))
    covered = F.aggregate(
        "__twice", F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda acc, i: F.struct(
            (acc["n"] + i + WINDOW - F.greatest(i, acc["end"])).alias("n"),
            (i + WINDOW).alias("end")))["n"]
    rows = rows.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long"))
    failed = (F.col("n_words") < MIN_WORDS) | (
        F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEATED_PERCENT)
    # A verdict that depends on the row number cannot be pushed, expanded, below the steps above.
    return rows.select("__row", *COUNTS[:-1], failed.alias("base_failed"), "__low",
                       F.monotonically_increasing_id().alias("__at"))


def single_bucket(word_hash: Column) -> Column:
    return word_hash.bitwiseAND(F.lit(BUCKETS - 1)).cast("int")


def pair_bucket(word_hash: Column, next_hash: Column) -> Column:
    return F.xxhash64(word_hash, next_hash).bitwiseAND(F.lit(BUCKETS - 1)).cast("int")


def trusted_ids(labels: DataFrame) -> DataFrame:
    """doc_id, fold and held_out of all good labelled documents; folds are dealt by hash of the id
    and none is held out of the weights.

    A document with both good and bad labels is not trusted.
    """
    bad = reduce(or_, [F.coalesce(F.col("quality"), F.lit(0)) != 1,
                       F.coalesce(F.col("toxic"), F.lit(1)) != 0])
    ids = labels.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max(bad).alias("bad"))
    return ids.filter("NOT bad").select(
        "doc_id", fold_of(F.col("doc_id")).alias("fold"), F.lit(False).alias("held_out"))


def fold_of(doc_id: Column) -> Column:
    return F.pmod(F.xxhash64(doc_id, F.lit("held out")), F.lit(FOLDS)).cast("int")


def with_trust(docs: DataFrame, trusted: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """`__text`, `fold` and `held_out` (both null where the document is not trusted) of each row.

    More ids than a broadcast may hold are broadcast as bitmaps where they are whole numbers that lie
    close enough for `MAX_BITMAPS`; else the texts are shuffled to them.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), filled(F.col(text_col)).alias("__text"))
    kinds = rows.schema["doc_id"].dataType, trusted.schema["doc_id"].dataType
    small = pin_small(trusted)
    bitmaps = None
    if small is None and all(isinstance(kind, IntegralType) for kind in kinds):
        bitmaps = pin_small(trusted.groupBy(F.bitmap_bucket_number("doc_id").alias("bucket")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position("doc_id")).alias("bits")), MAX_BITMAPS)
    if bitmaps is None:
        found = lookup_join(rows, trusted if small is None else small, "doc_id", pinned=small is not None)
        return found.select("__text", "fold", "held_out")
    at = F.bitmap_bit_position("doc_id")
    byte = F.conv(F.hex(F.substr("bits", (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    trust = F.getbit(byte, (at % 8).cast("int")) == 1
    found = rows.withColumn("bucket", F.bitmap_bucket_number("doc_id")).join(
        F.broadcast(bitmaps), "bucket", "left")
    return found.select("__text", F.when(trust, fold_of(F.col("doc_id").try_cast(kinds[1]))).alias("fold"),
                        F.when(trust, F.lit(False)).alias("held_out"))


def buckets_of(texts: DataFrame, tag: Column) -> DataFrame:
    """`tag` and `bucket` of each word and word pair of the texts of `with_trust`."""
    words = texts.select(tag.alias("tag"), words_of(F.lower(F.col("__text"))).alias("w"))
    words = words.select(
        "tag", F.explode(F.arrays_zip(F.col("w").alias("a"), F.slice(
            "w", F.lit(2), F.greatest(F.size("w") - 1, F.lit(0))).alias("b"))).alias("x"))
    words = words.select("tag", F.xxhash64("x.a").alias("a"), F.when(
        F.col("x.b").isNotNull(), F.xxhash64("x.b")).alias("b"))
    buckets = words.select("tag", F.explode(F.array(single_bucket(F.col("a")), F.when(
        F.col("b").isNotNull(), pair_bucket(F.col("a"), F.col("b"))))).alias("bucket"))
    return buckets.filter("bucket IS NOT NULL")


def fit_weights(texts: DataFrame) -> list[int]:
    """Log-likelihood ratio of each bucket between the trusted texts of `with_trust` that are not
    held out and the whole corpus. Both counts cover all texts and are smoothed by one a bucket.
    """
    good_one = F.coalesce((~F.col("held_out")).cast("int"), F.lit(0))
    counts = buckets_of(texts, good_one).groupBy("bucket").agg(
        F.count(F.lit(1)).alias("raw"), F.sum("tag").alias("good"))
    raw, good = [1] * BUCKETS, [1] * BUCKETS
    for row in counts.collect():          # one row a bucket, however large the corpus
        raw[row["bucket"]] += row["raw"]
        good[row["bucket"]] += row["good"]
    if sum(good) == BUCKETS:              # nothing is trusted: no evidence either way
        return [0] * BUCKETS
    shift = math.log(sum(raw)) - math.log(sum(good))
    return [round(SCALE * (math.log(g) - math.log(r) + shift)) for g, r in zip(good, raw, strict=True)]


def fold_weights(texts: DataFrame, weights: list[int]) -> dict[int, list[int]]:
    """For each fold what `weights`, which hold all trusted texts, would be without that fold's; no
    entry where nothing else is trusted.

    The counts of the corpus stay as they are, so only those of the trusted texts are needed.
    """
    counts = buckets_of(texts.filter("fold IS NOT NULL"), F.col("fold")).groupBy("tag", "bucket").count()
    each = {fold: [0] * BUCKETS for fold in range(FOLDS)}
    for row in counts.collect():          # a row for each fold and bucket, however large the corpus
        each[row["tag"]][row["bucket"]] = row["count"]
    good = [1 + sum(n) for n in zip(*each.values(), strict=True)]
    found = {}
    for fold, own in each.items():
        rest = [g - n for g, n in zip(good, own, strict=True)]
        if sum(rest) > BUCKETS:
            shift = math.log(sum(good)) - math.log(sum(rest))
            found[fold] = [w + round(SCALE * (math.log(r) - math.log(g) + shift))
                           for w, r, g in zip(weights, rest, good, strict=True)]
    return found


def fold_scores(texts: DataFrame, weights: list[int]) -> DataFrame:
    """`score` of each trusted text of `MIN_WORDS` words or more under the weights of the other folds."""
    tables = fold_weights(texts, weights)
    flat = [w for fold in range(FOLDS) for w in tables.get(fold, [0] * BUCKETS)]
    low = texts.filter(F.col("fold").isin(sorted(tables))).select("fold", F.transform(
        words_of(F.lower(F.col("__text"))), lambda word: F.xxhash64(word)).alias("low"))
    # The rows are dropped after they are written: pushed below the join, a condition on the words
    # would split all texts.
    scores = with_weights(low, flat).select(F.when(F.size("low") >= MIN_WORDS, mean_ratio(
        "low", "__weights", F.col("fold") * BUCKETS)).alias("score"))
    return cut_lineage(scores).filter("score IS NOT NULL")


def with_weights(rows: DataFrame, weights: list[int]) -> DataFrame:
    """`rows` and the weights in `__weights`, by a scalar subquery: a literal would stand in the text of
    every plan, megabytes that the driver writes and keeps."""
    table = rows.sparkSession.createDataFrame([(weights,)], "weights array<bigint>")
    return rows.withColumn("__weights", table.scalar())


def mean_ratio(hashes: str, weights: list[int] | str, start: Column | None = None) -> Column:
    """Mean weight of a row's words and pairs, given as a column of word hashes, in whole
    millionths; null without words. Bucket 0 stands at `start` of the weights, a list or a column.
    """
    start = F.lit(0) if start is None else start
    table = F.col(weights) if isinstance(weights, str) else F.split(
        F.lit(",".join(map(str, weights))), ",").cast("array<bigint>")
    pairs = F.greatest(F.size(hashes) - 1, F.lit(0))
    buckets = F.concat(F.transform(hashes, single_bucket), F.zip_with(
        F.slice(hashes, F.lit(1), pairs), F.slice(hashes, F.lit(2), pairs), pair_bucket))
    # Looked up at one place only: a subquery used at two would be copied into each row.
    total = F.aggregate(buckets, F.lit(0).cast("long"), lambda acc, bucket: acc + F.get(table, start + bucket))
    return F.when(F.size(hashes) > 0, F.floor(total / (2 * F.size(hashes) - 1)).cast("long"))


def judged(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """`__row` with the counts, base_failed, score and kept."""
    texts = with_trust(docs, cut_lineage(trusted_ids(labels)), id_col, text_col)
    weights = fit_weights(texts)
    low = quantile_values(fold_scores(texts, weights), ["score"], [CUT_SHARE])["score"][0]
    rows = with_weights(counted(docs, text_col), weights).withColumn(
        "score", mean_ratio("__low", "__weights")).drop("__low", "__weights")
    passed = F.lit(True) if low is None else F.col("score") >= math.floor(low - CUT_MARGIN * SCALE)
    return rows.withColumn("kept", ~F.col("base_failed") & passed & (F.col("__at") >= 0))


def quality_rules(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """One row per document: id, the counts, base_failed, score, kept.

    `labels` has doc_id, quality, toxic. The threshold is the score that `CUT_SHARE` of the trusted rows
    stay below under weights of the other folds, less `CUT_MARGIN`; without such rows every document
    passes it. A null text
    has no words and fails the base rule. Rows that repeat an id are judged each by itself; null
    ids are judged like any other. Extra columns are ignored. An empty table gives no rows.
    """
    rows = judged(docs.select(id_col, text_col), labels, id_col, text_col)
    return rows.select(F.col(f"__row.{id_col}").alias(id_col), *COUNTS, "score", "kept")


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id",
              text_col: str = "text") -> DataFrame:
    """The rows of the table that `quality_rules` keeps, all columns as they were."""
    return judged(docs, labels, id_col, text_col).filter("kept").select("__row.*")
