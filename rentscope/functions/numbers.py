"""Number parsing, rounding and scoring."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rentscope import vocab

FULL_WIDTH_DIGITS = "０１２３４５６７８９"


def ascii_digits(text: Column) -> Column:
    """Full-width digits as ASCII ones; a text without any is passed through."""
    swapped = F.translate(text, FULL_WIDTH_DIGITS, "0123456789")
    return F.when(text.rlike("[０-９]"), swapped).otherwise(text)


def to_number(text: Column) -> Column:
    """First signed decimal in a text, thousands commas ignored; null if there is none."""
    bare = F.regexp_replace(ascii_digits(text), ",", "")
    return F.regexp_extract(bare, vocab.NUMBER, 1).try_cast("double")


def blank_missing(text: Column) -> Column:
    """Null for the words a CSV uses for a missing value."""
    return F.when(~text.isin(vocab.MISSING_WORDS), text)


def half_even(value: Column) -> Column:
    """Round to a whole number, halves to the even neighbour."""
    return F.bround(value, 0).try_cast("bigint")


def confidence(sample_size: Column) -> Column:
    return F.least(F.lit(0.95), F.greatest(F.lit(0.35), sample_size / F.lit(20.0)))


def annual(monthly: Column) -> Column:
    return monthly * 12


def ratio(part: Column, whole: Column, digits: int = 3) -> Column:
    """``part / whole`` rounded; null where ``whole`` is zero."""
    return F.when(whole > 0, F.bround(part / whole, digits))
