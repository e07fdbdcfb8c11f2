"""Calendar parsing and cutoffs."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from rentscope.vocab import SPACE

ISO_MOMENT = (
    r"^\d{4}-\d{2}-\d{2}"
    r"(?:[T ](?:[01]\d|2[0-3])(?::[0-5]\d(?::[0-5]\d(?:[.,]\d+)?)?)?(?:Z|[+-]\d{2}:?\d{2})?)?$"
)
FORUM_STAMP = r"(?i)^(?:mon|tue|wed|thu|fri|sat|sun) ([a-z]{3} \d{1,2} \d{1,2}:\d{1,2}:\d{1,2} \d{4})$"


def roc_date(text: Column) -> Column:
    """Date of a Republic-of-China ``YYYMMDD`` text; null if it is not one."""
    digits = F.split_part(F.trim(text), F.lit("."), F.lit(1))
    western = F.concat(
        (F.substring(digits, 1, 3).try_cast("int") + 1911).cast("string"),
        F.substring(digits, 4, 4),
    )
    return F.when(digits.rlike(r"^\d{7,}$"), F.try_to_date(western, "yyyyMMdd"))


def forum_timestamp(text: Column) -> Column:
    """Timestamp of a forum post; an index-page ``M/D`` has no year and gives null."""
    spaced = F.trim(F.regexp_replace(text, f"[{SPACE}]+", " "))
    return F.coalesce(
        F.try_to_timestamp(F.regexp_extract(spaced, FORUM_STAMP, 1), F.lit("MMM d H:m:s yyyy")),
        F.when(
            spaced.rlike(r"^\d{4}/\d{1,2}/\d{1,2} \d{1,2}:\d{1,2}$"),
            F.try_to_timestamp(spaced, F.lit("yyyy/M/d H:m")),
        ),
        F.when(
            spaced.rlike(r"^\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}$"),
            F.try_to_timestamp(spaced, F.lit("yyyy-M-d H:m:s")),
        ),
    )


def review_date(text: Column) -> Column:
    """Calendar date as written in an ISO moment; the offset does not shift it."""
    return F.when(text.rlike(ISO_MOMENT), F.try_to_date(F.substring(text, 1, 10), "yyyy-MM-dd"))


def utc_date(epoch_seconds: Column) -> Column:
    """UTC date of epoch seconds, whatever the session's time zone is."""
    days = F.floor(epoch_seconds.cast("bigint") / F.lit(86400)).cast("int")
    return F.date_add(F.lit("1970-01-01").cast("date"), days)


def iso(stamp: Column, pattern: str = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS") -> Column:
    return F.date_format(stamp, pattern)


def utc_now() -> str:
    return dt.datetime.now(dt.timezone.utc).replace(microsecond=0).isoformat()


def cutoff(
    since: str | None = None, days: int | None = None, as_of: dt.datetime | None = None
) -> Column | None:
    """The oldest time to keep: the start of a given day, or so many days before ``as_of`` (default:
    now); without either there is no limit. Posts use vocab.POST_DAYS, reviews vocab.REVIEW_DAYS.

    A run that is given its time keeps the same rows whenever it is repeated.
    """
    if since:
        return F.to_timestamp(F.lit(since), "yyyy-MM-dd")
    now = F.current_timestamp() if as_of is None else F.lit(as_of)
    return now - F.make_dt_interval(F.lit(days)) if days is not None else None


def timeframe(text: str, today: dt.date | None = None) -> str:
    """``start end`` of a relative search window; an absolute one is returned as it is."""
    if not text.startswith("today"):
        return text
    spans = {"24-m": 730, "5-y": 1825, "12-m": 365}
    days = next((length for mark, length in spans.items() if mark in text), 730)
    end = today or dt.date.today()
    return f"{end - dt.timedelta(days=days)} {end}"
