"""Chat formatting by prefix-target expansion.

A turn is written `### role: text</turn>\\n`. Inside roles and texts a backslash becomes two, `##`
becomes `#\\#` and `</turn>` becomes `<\\/turn>` (and `:` in a role `\\:`), so neither control
string can occur in them and reading back is exact.

Every assistant turn becomes one example: all turns up to it, and only its own text trainable.
Turns after the last assistant turn form one more example with nothing trainable, so that the
examples hold the whole conversation. A conversation is gathered once, by its id; everything else
happens inside its row, as the longest example is the conversation itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.llm.text import filled

TRAINED = "assistant"
# --- fixed values: the template ----------------------------------------------
OPEN, MIDDLE, CLOSE = "### ", ": ", "</turn>\n"
ESCAPES = [("\\", "\\\\"), ("##", "#\\#"), ("</turn>", "<\\/turn>")]


def escaped(text: Column, more: list[tuple[str, str]] = ()) -> Column:
    for plain, safe in [*ESCAPES, *more]:
        text = F.replace(text, F.lit(plain), F.lit(safe))
    return text


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def format_examples(turns: DataFrame) -> DataFrame:
    """conv_id, example (from 0), n_turns, formatted, loss_start, loss_chars, last.

    `turns` has conv_id, turn, role, text. The loss span is in code points from 0; it has no
    characters in an example without a target. Turns are ordered by number (null first), then role
    and text, so repeated numbers and rows have a definite place. A null role or text is empty.
    Null ids form one conversation. Extra columns are ignored; an empty table gives no rows.
    """
    rows = turns.select("conv_id", F.struct(
        "turn", filled(F.col("role")).alias("role"), filled(F.col("text")).alias("text")).alias("t"))
    talks = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    talks = talks.withColumn("pieces", F.transform("turns", lambda t: F.struct(
        F.concat(F.lit(OPEN), escaped(t["role"], [(":", "\\:")]), F.lit(MIDDLE)).alias("head"),
        escaped(t["text"]).alias("body"), (t["role"] == TRAINED).alias("trained"))))
    talks = talks.withColumn("written", F.transform(
        "pieces", lambda p: F.concat(p["head"], p["body"], F.lit(CLOSE))))
    ends = F.filter(F.sequence(F.lit(1), F.size("pieces")), lambda i: F.element_at(
        "pieces", i)["trained"] | (i == F.size("pieces")))
    talks = talks.select("conv_id", "pieces", "written", F.posexplode(ends).alias("example", "end"))
    before = F.array_join(F.slice("written", F.lit(1), F.col("end") - 1), "")
    target = F.element_at("pieces", F.col("end"))
    talks = talks.select(
        "conv_id", "example", F.col("end").alias("n_turns"), target.alias("target"),
        F.concat(before, target["head"]).alias("prompt"),
        (F.col("end") == F.size("pieces")).alias("last"))
    return talks.select(
        "conv_id", "example", F.col("n_turns").cast("long").alias("n_turns"),
        F.concat("prompt", F.col("target.body"), F.lit(CLOSE)).alias("formatted"),
        F.length("prompt").cast("long").alias("loss_start"),
        F.when(F.col("target.trained"), F.length("target.body")).otherwise(0).cast("long").alias(
            "loss_chars"), "last")


def read_turns(formatted: Column) -> Column:
    """Array of (role, text) of a formatted conversation."""
    whole = F.filter(F.split(formatted, CLOSE), lambda piece: piece != "")
    head = r"(?s)^### ((?:[^\\:]|\\.)*+): "
    return F.transform(whole, lambda piece: F.struct(
        unescaped(F.regexp_extract(piece, head, 1)).alias("role"),
        unescaped(F.regexp_replace(piece, head, "")).alias("text")))


def read_loss(examples: DataFrame) -> Column:
    """The text under the loss mask of an example, unescaped."""
    return unescaped(F.substring(
        examples["formatted"], (examples["loss_start"] + 1).cast("int"), examples["loss_chars"].cast("int")))


def read_back(examples: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars of the output of
    `format_examples`; formatted_chars counts all examples of the conversation."""
    turns = F.when(F.col("last"), read_turns(F.col("formatted")))
    rows = examples.select(
        "conv_id", "example", turns.alias("turns"), read_loss(examples).alias("loss"),
        F.length("formatted").cast("long").alias("chars"))
    told = F.array_join(F.transform("turns", lambda t: F.concat(
        t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    rows = rows.select("conv_id", "example", "loss", "chars", F.size("turns").alias("n"),
                       F.when(F.col("turns").isNotNull(), F.sha2(told, 256)).alias("told"))
    talks = rows.groupBy("conv_id").agg(
        F.max("n").cast("long").alias("n_turns"), F.max("told").alias("turns_sha256"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("example", "loss"))),
                                 lambda x: x["loss"]), "").alias("loss"),
        F.sum("chars").alias("formatted_chars"))
    return talks.select("conv_id", "n_turns", "turns_sha256",
                        F.length("loss").cast("long").alias("loss_chars"),
                        F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars")
