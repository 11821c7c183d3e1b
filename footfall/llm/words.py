"""Helpers on texts and words, all built from column functions."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE_CHARS = " \t\n\x0b\x0c\r"
SPACES = r"[\x20\x09-\x0D]+"
NOT_ALNUM = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def ascii_lower(text: Column) -> Column:
    """``A``-``Z`` in lower case, every other character as it is.

    ``lower`` is much the faster and does the same where a text is all ASCII.
    """
    is_ascii = F.octet_length(text) == F.char_length(text)
    by_char = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.when(is_ascii, F.lower(text)).otherwise(by_char)


def space_words(text: Column) -> Column:
    """Words between white space; NULL and blank texts have none."""
    trimmed = F.trim(F.coalesce(text, F.lit("")), F.lit(SPACE_CHARS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
        F.split(trimmed, SPACES)
    )


def alnum_words(text: Column) -> Column:
    """Words of letters, digits and non-ASCII characters; NULL has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), NOT_ALNUM), "")


def fresh_name(df: DataFrame, name: str) -> str:
    """``name``, or a longer one where ``df`` has a column called so already."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
