"""Expressions shared by the operators that use DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: ``[\x20\x09-\x0D]``
BLANKS = " \t\n\x0b\x0c\r"
BLANK = r"[\x20\x09-\x0D]"


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once (a lambda binding)."""
    return F.element_at(F.transform(F.array(value), body), 1)


def split_words(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text that isn't null."""
    return let(F.btrim(text, F.lit(BLANKS)), lambda t: F.when(t == "", F.array().cast("array<string>"))
               .otherwise(F.split(t, BLANK + "+")))


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, every other character as it stands."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(text, upper, upper.lower())
