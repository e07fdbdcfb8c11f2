"""Public price pages of other products to price benchmarks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rentscope import vocab
from rentscope.functions import dates, money, text
from rentscope.operators import quantiles, ranking
from rentscope.operators.metrics import one_row
from rentscope.session import materialise
from rentscope.sources import html_pages

BENCHMARK = ["product", "pricing_plan_name", "manual_verified_price_ntd", "source_url"]


def enabled(sources: DataFrame) -> DataFrame:
    """Sources that are not switched off; an unset switch counts as on."""
    return sources.filter(F.coalesce("enabled", F.lit(True)))


def pages_of(sources: DataFrame, pages: DataFrame, newest: Sequence[str]) -> DataFrame:
    """Text of the newest stored page of each address that a source names.

    Pages nobody asks for are dropped before the parser runs.
    """
    wanted = pages.join(sources.select("source_url").distinct(), "source_url", "left_semi")
    return html_pages.page_text(ranking.newest_per_key(wanted, ["source_url"], newest))


def records(
    sources: DataFrame, pages: DataFrame, newest: Sequence[str], checked_at: str | None = None
) -> DataFrame:
    """One price record per enabled source.

    ``pages`` holds source_url and html, and may hold ``crawl_status``
    (``robots_blocked`` or ``fetch_failed``, with ``crawl_error``) for a page that
    could not be read. A source without a page is ``manual_only``.
    """
    kept = enabled(sources)
    unset = F.lit(None).cast("string")
    extra = {c: unset for c in ("crawl_status", "crawl_error") if c not in pages.columns}
    found = _read_pages(pages_of(kept, pages.withColumns(extra) if extra else pages, newest))
    joined = kept.join(found, "source_url", "left")
    product = F.coalesce(F.nullif("product", F.lit("")), text.url_host(F.col("source_url")))
    joined = joined.withColumns(
        {"crawl_status": F.coalesce("crawl_status", F.lit("manual_only")), "product": product}
    )
    price = F.col("manual_verified_price_ntd")
    return joined.select(
        "product",
        F.coalesce("category", F.lit(vocab.DEFAULT_CATEGORY)).alias("category"),
        "source_url",
        F.lit(checked_at or dates.utc_now()).alias("checked_at"),
        "pricing_plan_name",
        price.alias("manual_verified_price_ntd"),
        "page_title",
        money.merge_prices(F.col("_prices"), price).alias("extracted_price_values_ntd"),
        F.coalesce("_percents", F.array().cast("array<double>")).alias("extracted_percent_values"),
        F.coalesce("_snippet", _manual_snippet()).alias("pricing_text_snippet"),
        _notes().alias("notes"),
        "crawl_status",
    )


def _read_pages(found: DataFrame) -> DataFrame:
    """What a record takes from a page, so that the join carries no page text."""
    status = F.coalesce("crawl_status", F.lit("crawled"))
    body = F.when(status == "crawled", F.col("page_text"))
    return found.select(
        "source_url",
        status.alias("crawl_status"),
        "crawl_error",
        F.when(status == "crawled", F.col("page_title")).alias("page_title"),
        money.page_prices(body).alias("_prices"),
        money.page_percents(body).alias("_percents"),
        text.price_snippet(body).alias("_snippet"),
    )


def _manual_snippet() -> Column:
    price = F.col("manual_verified_price_ntd")
    told = F.concat(
        F.lit("Manual verified benchmark: "),
        F.coalesce(F.nullif("pricing_plan_name", F.lit("")), F.col("product")),
        F.lit(" = NT$"),
        F.format_number(price, 0),
        F.lit(" (checked "),
        F.coalesce("checked_date", F.lit("N/A")),
        F.lit(")."),
    )
    return F.when(price.isNotNull(), told).otherwise("")


def _notes() -> Column:
    notes, status = F.coalesce("notes", F.lit("")), F.col("crawl_status")
    blocked = F.lit(" robots.txt blocked automated fetch; manual price retained.")
    failed = F.concat(F.lit(" Crawl failed: "), F.coalesce("crawl_error", F.lit("")))
    return (
        F.when(status == "robots_blocked", F.concat(notes, blocked))
        .when(status == "fetch_failed", F.concat(notes, failed))
        .otherwise(F.col("notes"))
    )


def verified_benchmarks(rows: DataFrame) -> DataFrame:
    """Records with a verified price, as a table of its own."""
    return rows.filter(F.col("manual_verified_price_ntd").isNotNull()).select(*BENCHMARK)


def verified_prices(rows: DataFrame) -> DataFrame:
    """Every different verified price with its number of records, as a table of its own."""
    price = F.col("manual_verified_price_ntd")
    return rows.filter(price.isNotNull()).groupBy(price.alias("price_ntd")).agg(F.count(F.lit(1)).alias("records"))


def _is_incumbent(own_name: str) -> Column:
    return ~text.contains_ignoring_case(F.col("product"), own_name)


def incumbents(rows: DataFrame, own_name: str) -> DataFrame:
    """Records of other products than one's own."""
    return rows.filter(_is_incumbent(own_name))


def products(rows: DataFrame) -> DataFrame:
    """The product of each record, as a table of its own."""
    return rows.filter(F.col("product").isNotNull()).select("product", "source_url")


def _first_values(counts: DataFrame, kind: str, n: int, to: str, name: str) -> DataFrame:
    found = counts.filter(F.col("kind") == kind).select(F.col("key").cast(to).alias("v"))
    return found.orderBy("v").limit(n).agg(F.sort_array(F.collect_list("v")).alias(name))


def _counts(rows: DataFrame, wanted: Column | None = None) -> DataFrame:
    """The tally of the wanted records, stored once; all figures of a summary come from it.

    ``products``, ``verified_benchmarks`` and ``verified_prices`` grow with the records, so they are
    tables at every size; the tally has their lengths.
    """
    wanted = F.lit(True) if wanted is None else wanted
    price = F.col("manual_verified_price_ntd")

    def of_wanted(values: Column) -> Column:
        none = F.array().cast("array<string>")
        return F.coalesce(F.when(wanted, values.cast("array<string>")), none)

    counts = ranking.tally(
        rows,
        {
            "price": of_wanted(F.col("extracted_price_values_ntd")),
            "verified": of_wanted(F.array(price)),
            "percent": of_wanted(F.col("extracted_percent_values")),
            "record": F.concat(
                F.array(F.lit("any")),
                ranking.flag("all", wanted),
                ranking.flag("product", wanted & F.col("product").isNotNull()),
                ranking.flag("benchmark", wanted & price.isNotNull()),
            ),
        },
    )
    return materialise(counts, "price-counts")


def _sizes() -> list[Column]:
    return [
        ranking.counted("record", name).alias(f"{name}_count") for name in ("product", "benchmark")
    ]


def summary(rows: DataFrame) -> DataFrame:
    """Record count, observed prices and percentages, in one row."""
    counts = _counts(rows)
    return one_row(
        counts.agg(
            F.lit(dates.utc_now()).alias("generated_at"),
            F.lit(vocab.PRICE_SOURCE).alias("source"),
            ranking.counted("record", "all").alias("pages_checked"),
            F.lit(vocab.PRICE_NOTE).alias("note"),
            *_sizes(),
            F.count_if(F.col("kind") == "verified").alias("verified_price_count"),
        ),
        _first_values(counts, "price", 50, "int", "price_values_observed_ntd"),
        _first_values(counts, "percent", 30, "double", "percent_values_observed"),
    )


def report_summary(rows: DataFrame, own_name: str) -> DataFrame:
    """Price figures of other products for the evidence report, in one row.

    The benchmark is the median of verified prices, or, without any, of the
    candidates that look like a monthly fee.
    """
    counts = _counts(rows, _is_incumbent(own_name)).withColumn(
        "value", F.when(F.col("kind").isin("price", "verified"), F.col("key").cast("bigint"))
    )
    fee = (F.col("kind") == "price") & F.col("value").between(*vocab.MONTHLY_FEE_RANGE)
    median = F.coalesce(
        quantiles.of_counts("value", "count", 0.5, F.col("kind") == "verified"),
        quantiles.of_counts("value", "count", 0.5, fee),
    )
    return one_row(
        counts.agg(
            F.lit(vocab.PRICE_SOURCE).alias("source"),
            ranking.counted("record", "all").alias("pages_checked"),
            median.cast("bigint").alias("median_monthly_like_price_ntd"),
            F.lit(vocab.PRICE_NOTE).alias("note"),
            (ranking.counted("record", "any") > 0).alias("available"),
            *_sizes(),
        ),
        _first_values(counts, "price", 50, "int", "candidate_price_values_ntd"),
    )
