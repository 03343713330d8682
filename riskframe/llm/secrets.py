"""Secrets in texts, in DataFrame operations only.

Fixed patterns find assignments, access keys and long hex runs. Every other long token with
letters and digits is judged by two character Markov models, one of random strings and one of
ordinary words, by their mean log-likelihood ratio per step.

Offsets are code points: the pieces between matches and the matches themselves are measured, so
no position has to be searched for. One pass reads the texts; training and judging work on the
short tables it leaves. The models are tables over pairs of ASCII characters, of fixed size.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.llm.text import filled
from riskframe.session import cut_lineage

# --- fixed values: patterns, kinds in their order ---------------------------
KINDS = ["assign", "access", "hex", "random"]
ASSIGN = (r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
          r"""([A-Za-z0-9+/_.=-]+)""")
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{24,}"          # maximal runs, so the same as all runs less the short ones
MIN_VALUE, MIN_ACCESS = 6, 20
TOKEN = r"[A-Za-z0-9+/_=-]{20,}"
WORD = r"[A-Za-z_]{8,}"

BLOCK = 256               # elements summed one by one; longer arrays are summed by blocks
MIN_RATIO = 0.5           # mean log-likelihood ratio per step from which a token is a secret
SCALE = 1_000_000         # ratios are whole millionths
CHARS = 128
ALPHABET = 66             # letters, digits, + / _ = -: what smoothing counts on
MASK = "[SECRET]"

SPAN = "array<struct<start:int,kind:int,end:int>>"


def bound(value: Column, then: Callable[[Column], Column]) -> Column:
    """`then` of a value that is worked out once, however often `then` uses it."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def sums_before(sizes: Column) -> Column:
    """For each number of a non-empty array the sum of those before it.

    Appending copies an array, so blocks are summed each by itself and then put behind each other.
    """
    def run(numbers: Column) -> Column:
        return F.aggregate(
            numbers, F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("each")),
            lambda acc, x: F.struct((acc["at"] + x).alias("at"),
                                    F.array_append(acc["each"], acc["at"]).alias("each")))

    def behind(blocks: Column) -> Column:
        return F.flatten(F.zip_with(
            blocks, run(F.transform(blocks, lambda b: b["at"]))["each"],
            lambda b, before: F.transform(b["each"], lambda x: x + before)))

    return bound(sizes, lambda numbers: bound(F.transform(
        F.sequence(F.lit(0), F.floor((F.size(numbers) - 1) / BLOCK).cast("int")),
        lambda b: run(F.slice(numbers, b * BLOCK + 1, F.lit(BLOCK)))), behind))


def located(text: Column, found: Column, pattern: str) -> Column:
    """start, end and the match itself of all matches `found` of a pattern in a text."""
    def placed(pairs: Column) -> Column:
        before = sums_before(F.transform(pairs, lambda x: F.length(x["g"]) + F.length(x["m"])))
        return F.zip_with(pairs, before, lambda x, at: F.struct(
            (at + F.length(x["g"])).alias("start"),
            (at + F.length(x["g"]) + F.length(x["m"])).alias("end"), x["m"].alias("value")))

    gaps = F.split(text, pattern, -1)
    spans = bound(F.arrays_zip(found.alias("m"), F.slice(gaps, 1, F.size(found)).alias("g")), placed)
    return F.when(F.size(found) > 0, spans).otherwise(
        F.array().cast("array<struct<start:int,end:int,value:string>>"))


def as_kind(spans: Column, kind: int) -> Column:
    return F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), F.lit(kind).alias("kind"), s["end"].alias("end")))


def meets(spans: Column, token: Column) -> Column:
    """Whether a token overlaps one of the spans of a kind. These are apart and in order, so only the
    last that starts before the token's end can; it is found by halving."""
    def halved(acc: Column, _: Column) -> Column:
        middle = F.shiftright(acc["low"] + acc["high"], 1)
        starts = F.get(spans, middle)["start"] < token["end"]
        return F.when(acc["low"] >= acc["high"], acc).otherwise(F.struct(
            F.when(starts, middle + 1).otherwise(acc["low"]).alias("low"),
            F.when(starts, acc["high"]).otherwise(middle).alias("high")))

    last = F.aggregate(
        F.sequence(F.lit(1), F.length(F.bin(F.size(spans)))),
        F.struct(F.lit(0).alias("low"), F.size(spans).alias("high")), halved,
        lambda acc: acc["low"] - 1)
    return (F.size(spans) > 0) & F.coalesce(F.get(spans, last)["end"] > token["start"], F.lit(False))


def matched(docs: DataFrame, text_col: str) -> DataFrame:
    """The columns of the table in `__row`, with base (spans of the fixed patterns), values (their
    secrets) and tokens (to be judged)."""
    text = F.col("__text")
    rows = docs.select(F.struct(*map(F.col, docs.columns)).alias("__row"), filled(F.col(text_col)).alias("__text"))
    rows = rows.withColumns({
        "__a": F.regexp_extract_all(text, F.lit(ASSIGN), 0),
        "__x": F.regexp_extract_all(text, F.lit(ACCESS), 0),
        "__h": F.regexp_extract_all(text, F.lit(HEX), 0),
        "__t": F.filter(F.regexp_extract_all(text, F.lit(TOKEN), 0),
                        lambda t: t.rlike("[0-9]") & t.rlike("[A-Za-z]"))})
    rows = rows.withColumn("__v", F.when(
        F.size("__a") > 0, F.regexp_extract_all(text, F.lit(ASSIGN), 1)).otherwise(
        F.array().cast("array<string>")))
    rows = rows.withColumns({
        "__a": located(text, F.col("__a"), ASSIGN), "__x": located(text, F.col("__x"), ACCESS),
        "__h": located(text, F.col("__h"), HEX),
        "__t": F.when(F.size("__t") > 0, located(
            text, F.regexp_extract_all(text, F.lit(TOKEN), 0), TOKEN))})
    rows = rows.withColumns({
        "__a": F.filter("__a", lambda s, i: F.length(F.get(F.col("__v"), i)) >= MIN_VALUE),
        "__x": F.filter("__x", lambda s: s["end"] - s["start"] >= MIN_ACCESS)})
    rows = rows.select(
        "__row", "__t", "__a", "__x", "__h",
        F.array_sort(F.concat(as_kind(F.col("__a"), 0), as_kind(F.col("__x"), 1),
                              as_kind(F.col("__h"), 2))).alias("base"),
        F.concat(F.filter("__v", lambda v: F.length(v) >= MIN_VALUE),
                 F.transform("__x", lambda s: s["value"]),
                 F.transform("__h", lambda s: s["value"])).alias("values"))
    apart = F.filter(
        "__t", lambda t: t["value"].rlike("[0-9]") & t["value"].rlike("[A-Za-z]")
        & ~meets(F.col("__a"), t) & ~meets(F.col("__x"), t) & ~meets(F.col("__h"), t))
    return rows.select("__row", "base", "values", F.coalesce(
        apart, F.array().cast("array<struct<start:int,end:int,value:string>>")).alias("tokens"),
        # A filter that depends on the row number cannot be pushed, expanded, below these steps.
        F.monotonically_increasing_id().alias("__at"))


def step_counts(tokens: DataFrame) -> dict[tuple[int, int], int]:
    """How often a character follows another in the column `value`; 0 stands for the start."""
    chars = F.split("value", "")
    steps = tokens.select(F.explode(F.zip_with(
        F.concat(F.array(F.lit("")), chars), chars,
        lambda before, c: F.ascii(before) * CHARS + F.ascii(c))).alias("step"))
    rows = steps.filter(F.col("step") < CHARS * CHARS).groupBy("step").count().collect()
    return {divmod(r["step"], CHARS): r["count"] for r in rows}


def ratio_table(random: dict[tuple[int, int], int], plain: dict[tuple[int, int], int]) -> list[int]:
    """log P(step | random) - log P(step | ordinary) of all steps.

    Random strings are an even mixture of those seen and of even chances over the alphabet, since
    the next secret may use other characters. Ordinary counts are raised by one.
    """
    sums = [[0] * CHARS, [0] * CHARS]
    for total, counts in zip(sums, (random, plain), strict=True):
        for (before, _), n in counts.items():
            total[before] += n

    def ratio(a: int, b: int) -> int:
        seen = random.get((a, b), 0) / sums[0][a] if sums[0][a] else 1 / ALPHABET
        chance = (seen + 1 / ALPHABET) / 2
        return round(SCALE * (math.log(chance) - math.log(
            (plain.get((a, b), 0) + 1) / (sums[1][a] + ALPHABET))))
    return [ratio(a, b) for a in range(CHARS) for b in range(CHARS)]


def train(docs: DataFrame, found: DataFrame, text_col: str) -> list[int]:
    """The ratio table from all values the fixed patterns found (random) and the words of all
    documents (ordinary). Steps are counted, so no more than a pair of characters leaves a task."""
    random = step_counts(found.filter(F.size("values") > 0).select(F.explode("values").alias("value")))
    plain = step_counts(docs.select(F.explode(
        F.regexp_extract_all(filled(F.col(text_col)), F.lit(WORD), F.lit(0))).alias("value")))
    return ratio_table(random, plain)


def mean_ratio(token: Column, table: list[int]) -> Column:
    """Mean log-likelihood ratio per step of a token in whole millionths."""
    look = F.split(F.lit(",".join(map(str, table))), ",").cast("array<bigint>")
    chars = F.split(token, "")
    each = F.zip_with(F.slice(chars, F.lit(1), F.length(token) - 1),
                      F.slice(chars, F.lit(2), F.length(token) - 1),
                      lambda before, c: F.get(look, F.ascii(before) * CHARS + F.ascii(c)))
    total = F.aggregate(each, F.lit(0).cast("long"), lambda acc, x: acc + x)
    return F.floor(total / (F.length(token) - 1)).cast("long")


def secret_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, base and spans, each an array of (start, kind, end).

    Spans are in code points, the end exclusive, ordered by start and kind (a number in `KINDS`).
    `base` has what the fixed patterns find, `spans` those and the tokens the models judge random;
    a token that overlaps a base span is not added. A null or empty text has none. Rows that
    repeat an id are scanned each by itself. With no secret to learn from, random strings are taken
    as even over the alphabet. Extra columns are ignored. An empty table gives no rows.
    """
    found = cut_lineage(matched(docs.select(id_col, text_col), text_col).select(
        F.col(f"__row.{id_col}").alias(id_col), "base", "values", "tokens"))
    table = train(docs, found, text_col)
    return found.select(id_col, "base", with_random(table).alias("spans"))


def with_random(table: list[int]) -> Column:
    """The spans of a row of `matched` with those of its tokens that the models judge random."""
    added = F.filter("tokens", lambda t: mean_ratio(t["value"], table) >= int(MIN_RATIO * SCALE))
    return F.when(F.size("tokens") > 0, F.array_sort(F.concat(
        "base", as_kind(added, len(KINDS) - 1)))).otherwise(F.col("base"))


def mask_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The table with the spans of `secret_spans` masked in its texts.

    Texts are matched once for training and once for masking, so that none is shuffled. A text
    without secrets stays as it is, also a null one. All rows stay.
    """
    found = cut_lineage(matched(docs.select(id_col, text_col), text_col).filter(
        (F.size("values") > 0) & (F.col("__at") >= 0)).select(F.col(f"__row.{id_col}").alias(id_col), "values"))
    table = train(docs, found, text_col)
    rows = matched(docs, text_col).withColumn("spans", with_random(table))
    text = F.col(f"__row.{text_col}")
    return rows.select(*[
        masked(text, F.col("spans")).alias(c) if c == text_col else F.col(f"__row.{c}").alias(c)
        for c in docs.columns])


def span_list(spans: Column) -> Column:
    """kind:start:end of all spans, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def masked(text: Column, spans: Column) -> Column:
    """The text with each span, or run of overlapping spans, replaced by `MASK`."""
    done = F.aggregate(
        spans, F.struct(F.lit("").alias("out"), F.lit(0).alias("at")),
        lambda acc, s: F.struct(
            F.when(s["start"] >= acc["at"], F.concat(acc["out"], F.substr(
                text, acc["at"] + 1, s["start"] - acc["at"]), F.lit(MASK))).otherwise(
                acc["out"]).alias("out"),
            F.greatest(acc["at"], s["end"]).alias("at")),
        lambda acc: F.concat(acc["out"], F.substr(text, acc["at"] + 1, F.length(text))))
    return F.when(F.size(spans) > 0, done).otherwise(text)
