"""Words of a text as Spark expressions: maximal runs of characters other than
space, \\t, \\n, \\v, \\f, \\r.  A null text is read as the empty text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Java and RE2 class of the characters between words.
BLANK = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def text_or_empty(text: str | Column) -> Column:
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def words(text: Column) -> Column:
    """Array of the words of a non-null text."""
    return F.array_remove(F.split(text, BLANK + "+", -1), "")


def n_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def count_chars(text: Column, char_class: str) -> Column:
    """How many characters of ``text`` are in ``[char_class]`` (code points)."""
    return F.length(F.regexp_replace(text, f"[^{char_class}]+", "")).cast("long")
