"""Amounts, areas and percentages found in free text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rentscope import vocab
from rentscope.functions.numbers import ascii_digits

DECIMAL = r"^[-+]?(?:\d+\.?\d*|\.\d+)(?:[eE][-+]?\d+)?$"


def _double(token: Column) -> Column:
    return F.when(token.rlike(DECIMAL), token.try_cast("double"))


def _whole(value: Column) -> Column:
    return F.bround(value, 0).try_cast("bigint")


def _matches(text: Column, pattern: str, group: int = 1) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


def money_token(token: Column) -> Column:
    """Amount a money token stands for; null if it is not a number.

    ``2.8萬`` and ``2萬8`` are 28000, ``28.000`` and ``28,000`` too, ``28k`` and
    ``28千`` as well; any other number loses its fraction.
    """
    return _amount(ascii_digits(F.regexp_replace(F.trim(token), " ", "")))


def _amount(text: Column) -> Column:
    wan = F.regexp_extract(text, vocab.WAN_AMOUNT, 1)
    extra = F.regexp_extract(text, vocab.WAN_AMOUNT, 2)
    thousands = F.regexp_replace(text, "[kK千]$", "")
    return (
        F.when(
            wan != "",
            _whole(
                wan.try_cast("double") * 10000
                + F.coalesce(extra.try_cast("double"), F.lit(0.0)) * 1000
            ),
        )
        .when(text.rlike(r"^\d+\.\d{3}$"), F.regexp_replace(text, r"\.", "").try_cast("bigint"))
        .when(text.contains(","), F.regexp_replace(text, ",", "").try_cast("bigint"))
        .when(text.rlike(r"^\d+(?:\.\d+)?[kK]$") | text.endswith("千"),
              _whole(_double(thousands) * 1000))
        .otherwise(_double(text).try_cast("bigint"))
    )


def plausible_rent(value: Column) -> Column:
    return value.between(*vocab.RENT_RANGE)


def smallest(values: Column, n: int) -> Column:
    """The n smallest distinct values of an array."""
    return F.slice(F.array_sort(F.array_distinct(values)), 1, n)


def post_prices(text: Column, keep: int = 10) -> Column:
    """Plausible monthly rents named in a post.

    A labelled amount may take any form; the other patterns fix the form of what
    they match, so each of those is read straight away.
    """
    text = ascii_digits(text)
    labelled = F.concat(
        _matches(text, vocab.MONTHLY_RENT_LABEL), _matches(text, vocab.MONEY_LABEL)
    )
    grouped = F.concat(
        F.transform(_matches(text, vocab.DOT_THOUSANDS), lambda t: F.replace(t, F.lit("."), F.lit(""))),
        F.transform(_matches(text, vocab.COMMA_THOUSANDS), lambda t: F.replace(t, F.lit(","), F.lit(""))),
        _matches(text, vocab.PLAIN_AMOUNT),
    )
    thousands = F.concat(_matches(text, vocab.K_AMOUNT), _matches(text, vocab.QIAN_AMOUNT))
    amounts = F.concat(
        F.transform(labelled, _amount),
        F.transform(grouped, lambda t: t.try_cast("bigint")),
        F.transform(thousands, lambda t: _whole(t.try_cast("double") * 1000)),
        F.transform(_matches(text, vocab.WAN_AMOUNT, 0), _amount),
    )
    return smallest(F.filter(amounts, plausible_rent), keep)


def post_areas(text: Column, keep: int = 10) -> Column:
    """Floor areas in ping named in a post."""
    found = _matches(ascii_digits(text), vocab.AREA)
    areas = F.transform(found, lambda t: t.try_cast("double"))
    return smallest(F.filter(areas, lambda a: a.between(*vocab.AREA_RANGE)), keep)


def page_prices(text: Column, keep: int = 30) -> Column:
    """Numbers on a web page that may be prices; long digit runs are read in pieces."""
    values = F.transform(
        _matches(ascii_digits(text), vocab.PAGE_PRICE),
        lambda t: F.replace(t, F.lit(","), F.lit("")).try_cast("int"),
    )
    return smallest(F.filter(values, lambda v: v.between(*vocab.PAGE_PRICE_RANGE)), keep)


def page_percents(text: Column, keep: int = 20) -> Column:
    found = _matches(ascii_digits(text), vocab.PERCENT)
    values = F.transform(found, lambda t: t.try_cast("double"))
    return smallest(F.filter(values, lambda v: (v > 0) & (v <= 100)), keep)


def merge_prices(found: Column, verified: Column) -> Column:
    """Sorted distinct union of found prices and one verified price."""
    extra = F.when(verified.isNotNull(), F.array(verified)).otherwise(
        F.array().cast("array<int>")
    )
    return F.array_sort(F.array_union(F.coalesce(found, F.array().cast("array<int>")), extra))
