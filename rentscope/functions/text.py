"""Tags, snippets and masks over free text."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from rentscope import vocab

WHITE = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())
REGEX_SIGNS = set(r"\^$.?*+()[]{}")
# A class of signs and nothing else: no ranges, escapes or nested classes.
SIGN_CLASS = re.compile(r"\[([^\\\[\]^&-]+)\]")
PLAIN = rf"[\x00-/:-\x{{{vocab.FIRST_WIDE - 1:x}}}]"
# Ideographic space is wide, so a stretch of plain signs has one beginning and is tried once.
BETWEEN = "[" + vocab.SPACE.replace(r"\u3000", "") + ":,.]"
GIST = rf"(?<!{PLAIN})({BETWEEN}*+{PLAIN}{{6}}){PLAIN}+"


def _present(names: Sequence[str], tests: Sequence[Column]) -> Column:
    marks = F.array(*[F.when(test, F.lit(name)) for name, test in zip(names, tests)])
    return F.array_compact(marks) if names else F.array().cast("array<string>")


def gist(text: Column) -> Column:
    """A text in which every word of wide signs, amount and area is found as in the whole.

    Digits and wide signs stay. Of a stretch of other signs between them, what can stand between a label, an
    amount and its unit stays, and the six signs behind that, so the longest unit (``ping``) and the sign
    behind it; an ``x``, which none of the patterns reads, stands for the rest. Most of a text in Latin script
    goes, so the many searches for words and amounts run over little.
    """
    return F.regexp_replace(text, GIST, "$1x")


def _holds(text: Column, word: str, short: Column | None) -> Column:
    """Whether a word occurs; a word of wide signs is looked for in the text's gist, if that is given."""
    wide = short is not None and all(ord(sign) >= vocab.FIRST_WIDE for sign in word)
    return (short if wide else text).contains(word)


def occurs(text: Column, pattern: str, short: Column | None = None) -> Column:
    """Whether a pattern occurs, in any case of its letters; ``short`` is the text's gist.

    Plain words without case are searched as bytes, which is several times as fast as
    a regular expression over their alternation.
    """
    if REGEX_SIGNS & set(pattern):
        return text.rlike("(?iu)" + pattern)
    words = pattern.split("|")
    cased = [w for w in words if w.lower() != w.upper()]
    tests = [_holds(text, w, short) for w in words if w not in cased]
    if cased:
        distinct = dict.fromkeys(w.lower() if w.isascii() else w for w in cased)
        tests.append(text.rlike("(?iu)" + "|".join(distinct)))
    return reduce(lambda a, b: a | b, tests)


def has_sign(text: Column, pattern: str) -> Column:
    """Whether a pattern occurs; the signs of a bare class are searched as bytes."""
    signs = SIGN_CLASS.fullmatch(pattern)
    if signs is None:
        return text.rlike(pattern)
    return reduce(lambda a, b: a | b, [text.contains(sign) for sign in signs[1]])


def category_tags(text: Column, patterns: Mapping[str, str], short: Column | None = None) -> Column:
    """Names of the categories whose pattern occurs, sorted."""
    names = sorted(patterns)
    return _present(names, [occurs(text, patterns[name], short) for name in names])


def name_tags(
    text: Column, names: Sequence[str] = vocab.DISTRICTS, short: Column | None = None
) -> Column:
    """The names a text contains, in the order of the list."""
    return _present(names, [_holds(text, name, short) for name in names])


def keyword_tags(
    text: Column,
    patterns: Mapping[str, str] = vocab.KEYWORDS,
    names: Sequence[str] = vocab.DISTRICTS,
    short: Column | None = None,
) -> Column:
    """Category and district tags together, sorted."""
    tags = F.concat(category_tags(text, patterns, short), name_tags(text, names, short))
    return F.array_sort(F.array_distinct(tags))


def pain_tags(text: Column, patterns: Mapping[str, str] = vocab.PAIN_POINTS) -> Column:
    return category_tags(text, patterns)


def asks_price(
    text: Column,
    pricing: str = vocab.KEYWORDS["pricing"],
    question_words: str = vocab.QUESTION_WORDS,
    question_marks: str = vocab.QUESTION_MARKS,
    short: Column | None = None,
) -> Column:
    """Whether a text speaks of a price and asks something."""
    asks = occurs(text, question_words, short) | has_sign(text, question_marks)
    return occurs(text, pricing, short) & asks


def collapse(text: Column) -> Column:
    """Runs of white space as one space, none at the ends."""
    spaced = F.translate(text, WHITE, " " * len(WHITE))
    return F.trim(F.regexp_replace(spaced, " {2,}", " "))


def snippet(text: Column, length: int = 200) -> Column:
    """Start of a text on one line, an ellipsis in the last place where it is cut.

    A beginning that is too long already decides; only where white space fills it is the whole text read.
    """
    def cut(line: Column) -> Column:
        return F.concat(F.substring(line, 1, length - 1), F.lit("…"))

    begin, line = collapse(F.substring(text, 1, 4 * length)), collapse(text)
    whole = F.when(F.length(line) <= length, line).otherwise(cut(line))
    return F.when(F.length(begin) > length, cut(begin)).otherwise(whole)


def price_snippet(
    text: Column, length: int = 700, anchors: Sequence[str] = vocab.SNIPPET_ANCHORS
) -> Column:
    """The part of a page around its first price word, else its start."""
    places = F.array(*[F.nullif(F.locate(a, text), F.lit(0)) for a in anchors])
    first = F.array_min(F.array_compact(places))
    start = F.greatest(F.lit(1), F.coalesce(first, F.lit(1)) - 120)
    return F.substr(text, start, F.lit(length))


def mask_mail(text: Column) -> Column:
    masked = F.regexp_replace(text, vocab.EMAIL, vocab.EMAIL_MASK)
    return F.when(text.contains("@"), masked).otherwise(text)


def mask_post(text: Column) -> Column:
    """Hide phone numbers, then mail addresses, then LINE accounts."""
    text = mask_mail(F.regexp_replace(text, vocab.PHONE, vocab.PHONE_MASK))
    return F.regexp_replace(text, vocab.LINE_ID, "$1" + vocab.LINE_ID_MASK)


def mask_review(text: Column) -> Column:
    """Hide mail addresses, then mobile numbers."""
    return F.regexp_replace(mask_mail(text), vocab.MOBILE, vocab.PHONE_MASK)


def post_body(text: Column) -> Column:
    """A post without its origin line, signature and blank runs."""
    body = F.split_part(text, F.lit(vocab.POST_ORIGIN_MARK), F.lit(1))
    body = F.split_part(body, F.lit(vocab.POST_SIGNATURE_MARK), F.lit(1))
    body = F.when(body.contains("\n\n\n"), F.regexp_replace(body, r"\n{3,}", "\n\n")).otherwise(body)
    return F.btrim(body, F.lit(WHITE))


def thread_id(url: Column) -> Column:
    """Last part of a thread's address without ``.html``."""
    last = F.element_at(F.split(F.regexp_replace(url, "/+$", ""), "/"), -1)
    return F.regexp_replace(last, r"\.html", "")


def url_host(url: Column) -> Column:
    return F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)", 1)


def contains_ignoring_case(text: Column, word: str) -> Column:
    return F.lower(F.coalesce(text, F.lit(""))).contains(word.lower())


def strip_json_guard(text: Column) -> Column:
    """JSON behind the five guard characters some feeds put in front."""
    return F.when(text.startswith(vocab.JSON_GUARD), F.substr(text, F.lit(6))).otherwise(text)
