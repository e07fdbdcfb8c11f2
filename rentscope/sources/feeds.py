"""Review-feed pages and search-interest payloads held as JSON text.

Payloads are read as variants: an entry may be a record or a list, and may have fields nobody has heard of.
What cannot be read is not dropped in silence: ``review_rejects`` and ``interest_rejects`` hold the payloads that
gave no rows, with the reason.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rentscope.functions import dates, text

#: Fields of a review entry that are read.
ENTRY_FIELDS = ["im:rating", "title", "content", "updated", "id", "link"]
VARIANTS = "array<variant>"


def _is_kind(value: Column, kind: str) -> Column:
    return F.coalesce(F.startswith(F.schema_of_variant(value), F.lit(kind)), F.lit(False))


def _present(value: Column) -> Column:
    return value.isNotNull() & ~F.coalesce(F.is_variant_null(value), F.lit(False))


def _text(value: str, path: str) -> Column:
    return F.try_variant_get(F.col(value), path, "string")


def _feed_entry(payload: str) -> Column:
    return F.try_variant_get(F.try_parse_json(payload), "$.feed.entry", "variant")


def _entries(pages: DataFrame, payload: str) -> DataFrame:
    """One row per entry of a page, as ``_e``; a page holds a list of entries or one entry alone."""
    entry = F.col("_entry")
    listed = F.when(_is_kind(entry, "OBJECT"), F.array(entry)).otherwise(F.try_variant_get(entry, "$", VARIANTS))
    rows = pages.withColumn("_entry", _feed_entry(payload))
    return rows.withColumn("_e", F.explode(listed)).drop("_entry", payload)


def review_entries(pages: DataFrame, payload: str = "payload") -> DataFrame:
    """One row per review of a feed page; the other columns of the page stay.

    Entries without a rating describe the app and are left out.
    """
    blank = F.lit("")
    rated = _present(F.try_variant_get(F.col("_e"), '$["im:rating"]', "variant"))
    return (
        _entries(pages, payload)
        .filter(rated)
        .withColumns(
            {
                "review_id": F.coalesce(_text("_e", "$.id.label"), blank),
                "title": F.coalesce(_text("_e", "$.title.label"), blank),
                "content": F.coalesce(_text("_e", "$.content.label"), blank),
                "rating": F.trim(_text("_e", '$["im:rating"].label')).try_cast("int"),
                "updated": _text("_e", "$.updated.label"),
                "source_url": F.coalesce(_text("_e", "$.link.attributes.href"), blank),
            }
        )
        .drop("_e")
    )


def unknown_fields(pages: DataFrame, payload: str = "payload") -> DataFrame:
    """field and entries: how many entries of all pages have a field that is not read."""
    entries = _entries(pages.select(payload), payload).filter(_is_kind(F.col("_e"), "OBJECT"))
    fields = entries.lateralJoin(pages.sparkSession.tvf.variant_explode(F.col("_e").outer()))
    unread = fields.filter(~F.col("key").isin(ENTRY_FIELDS)).select(F.col("key").alias("field"))
    return unread.groupBy("field").agg(F.count(F.lit(1)).alias("entries"))


def _rejected(df: DataFrame, payload: str, parsed: Column, reasons: list[tuple[Column, str]]) -> DataFrame:
    """The other columns of payloads that cannot be read, with ``reason``."""
    reason = F.when(F.col(payload).isNull(), "no payload").when(F.col("_v").isNull(), "not JSON")
    for condition, name in reasons:
        reason = reason.when(condition, name)
    rows = df.withColumn("_v", parsed).withColumn("reason", reason)
    return rows.filter(F.col("reason").isNotNull()).drop("_v", payload)


def review_rejects(pages: DataFrame, payload: str = "payload") -> DataFrame:
    """Feed pages that cannot be read. A feed without an entry is a page without reviews, not one of these."""
    feed, entry = (F.try_variant_get(F.col("_v"), path, "variant") for path in ("$.feed", "$.feed.entry"))
    readable = _is_kind(entry, "OBJECT") | _is_kind(entry, "ARRAY")
    return _rejected(
        pages,
        payload,
        F.try_parse_json(payload),
        [(~_is_kind(feed, "OBJECT"), "no feed"), (_present(entry) & ~readable, "entry is neither record nor list")],
    )


def with_app(pages: DataFrame, apps: DataFrame, country: str = "tw") -> DataFrame:
    """Feed pages with name and country of their app, by ``app_id``.

    The app list is short and is broadcast when the planner sees its size.
    """
    known = apps.select(
        "app_id", "app_name", F.coalesce("country", F.lit(country)).alias("country")
    )
    return pages.join(known, "app_id")


def _trend(payload: str) -> Column:
    return F.try_parse_json(text.strip_json_guard(F.col(payload)))


def interest_points(payloads: DataFrame, payload: str = "payload") -> DataFrame:
    """One row per week with data: week and interest, beside the payload's other columns."""
    timeline = F.try_variant_get(_trend(payload), "$.default.timelineData", VARIANTS)
    first = F.try_variant_get(F.col("_p"), "$.value[0]", "variant")
    points = payloads.withColumn("_p", F.explode(timeline)).drop(payload)
    return (
        points.filter(F.try_variant_get(F.col("_p"), "$.hasData", "boolean") & first.isNotNull())
        .withColumns(
            {
                "week": dates.utc_date(_text("_p", "$.time")),
                "interest": F.try_variant_get(F.col("_p"), "$.value[0]", "int"),
            }
        )
        .drop("_p")
    )


def interest_rejects(payloads: DataFrame, payload: str = "payload") -> DataFrame:
    """Search-interest payloads without a timeline that can be read, with the reason."""
    timeline = F.try_variant_get(F.col("_v"), "$.default.timelineData", "variant")
    return _rejected(payloads, payload, _trend(payload), [(~_is_kind(timeline, "ARRAY"), "no timeline")])
