"""Column expressions on texts shared by the operators.

Words are the runs between the six ASCII white-space characters; only A-Z are lower-cased.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
BLANKS = r"[\x20\x09-\x0D]+"
NOT_BLANK = r"[^\x20\x09-\x0D]"
# A letter that lower() changes and the A-Z rule does not.
OTHER_CAPITAL = r"[\p{IsUppercase}\p{IsTitlecase}&&[^A-Z]]"


def filled(text: Column) -> Column:
    """The text, empty where it is null."""
    return F.coalesce(text, F.lit(""))


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased and nothing else.

    `lower` is fast and does the same unless other capitals occur, which go the slow way.
    """
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).when(
        text.rlike(OTHER_CAPITAL), F.translate(text, UPPER, UPPER.lower())).otherwise(F.lower(text))


def words_of(text: Column) -> Column:
    """All words of the text in order; an empty array without any."""
    return F.array_remove(F.split(text, BLANKS), "")


def lines_of(text: Column) -> Column:
    """The \\n-split lines of the text."""
    return F.split(text, "\n")
