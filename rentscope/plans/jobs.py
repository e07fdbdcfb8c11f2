"""Whole jobs: read, transform, write."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rentscope import schemas, vocab
from rentscope.functions import dates
from rentscope.operators import benchmarks, cleaning, evidence, interest, metrics, segments, value_counts
from rentscope.operators import reviews as review_ops
from rentscope.operators import signals as signal_ops
from rentscope.operators.once import once
from rentscope.session import materialise
from rentscope.sinks import files, versions, warehouse
from rentscope.sources import feeds


def clean_open_data(
    raw: DataFrame, output: str | None = None, require_rows: bool = False
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Clean rent rows, their ingest form and the district summary.

    The clean rows are stored once and everything else is derived from that copy, so
    the raw text is parsed a single time.
    """
    rent = materialise(cleaning.clean_rent(cleaning.rental_rows(raw, require_rows)), "rent")
    ingest = cleaning.to_ingest(rent)
    summary = metrics.district_summary(rent)
    if output:
        files.write_csv(rent, f"{output}/rent_prices")
        files.write_csv(ingest, f"{output}/transactions_ingest")
        files.write_csv(summary, f"{output}/rent_summary_by_district")
    return rent, ingest, summary


def clean_and_load(
    raw: DataFrame, output: str, table: str, replace: bool = True, key: str | None = None
) -> dict:
    """Clean open data, load the transaction table and tell what was loaded.

    A load that is repeated with its key is not added twice.
    """
    _, ingest, _ = clean_open_data(raw, output, require_rows=True)
    count = warehouse.save_transactions(ingest, table, replace, key)
    districts = metrics.distinct_districts(ingest).first()["districts"]
    return {
        "ingested": count,
        "ingest_csv": f"{output}/transactions_ingest",
        "districts": districts,
        "source": vocab.RENT_SOURCE,
    }


def run_metrics(
    transactions: DataFrame, root: str, area_ping: float = 10.0, k: int = 4, **start
) -> dict:
    """Metrics, price bands and clusters of the transactions, published together."""
    table = transactions.select(
        "district", "building_type", "area_ping", "rent_ntd", "rent_per_ping",
        *[start[c] for c in ("row_number",) if start.get(c)],
    )
    found = materialise(metrics.district_metrics(table), "metrics")
    tables = {
        "district_metrics": found,
        "pricing_recommendations": metrics.recommendations(found, area_ping),
    }
    clusters, _ = segments.segment(table, k, **start)
    if clusters is not None:
        tables["rental_clusters"] = clusters
    counts = warehouse.publish(tables, root)
    return {
        "transactions": table.count(),
        "district_metrics": counts["district_metrics"],
        "recommendations": counts["pricing_recommendations"],
        "kmeans_clusters": counts.get("rental_clusters", 0),
        "updated_at": dt.datetime.now().isoformat(),
    }


def refresh_metrics(spark: SparkSession, table: str, state: str, root: str, area_ping: float = 10.0) -> dict:
    """Metrics and price bands of a stored transaction table, from the loads since the last refresh.

    ``state`` holds the counts of values between refreshes. Clusters need all rows; ``run_metrics`` has them.
    """
    found = materialise(value_counts.metrics(value_counts.refresh(spark, table, state)), "metrics")
    counts = warehouse.publish(
        {"district_metrics": found, "pricing_recommendations": metrics.recommendations(found, area_ping)}, root
    )
    return {
        "transactions": versions.rows_of(spark, table),
        "district_metrics": counts["district_metrics"],
        "recommendations": counts["pricing_recommendations"],
        "updated_at": dt.datetime.now().isoformat(),
    }


def forum_signals(
    boards: Sequence[DataFrame],
    per_board: int | None = None,
    local_only: bool = True,
    since: dt.datetime | None = None,
    output: str | None = None,
    days: int | None = None,
    as_of: dt.datetime | None = None,
    **dictionaries,
) -> DataFrame:
    """Stored articles of several boards to kept signals, with raw threads and a CSV.

    Posts are kept from ``since`` on, or for so many ``days`` before ``as_of`` (default: now), or all of them.
    """
    if since is None:
        since = dates.cutoff(days=days, as_of=as_of)
    articles = signal_ops.newest_articles(signal_ops.union_boards(boards), per_board, since)
    if output:
        articles = materialise(articles, "articles")
        files.write_rows(signal_ops.raw_threads(articles), f"{output}/threads")
    found = once(signal_ops.to_signals(articles, **dictionaries)).filter(
        signal_ops.keep(local_only, since)
    )
    if output:
        found = materialise(found, "signals")
        told = found.withColumn("posted_at", dates.iso(F.col("posted_at"), "yyyy-MM-dd'T'HH:mm:ss"))
        files.write_rows(told, f"{output}/signals")
        files.write_csv(told, f"{output}/signals_csv")
    return found


def review_signals(
    pages: DataFrame,
    first_day: dt.date | None = None,
    output: str | None = None,
    days: int = vocab.REVIEW_DAYS,
    as_of: dt.datetime | None = None,
    **how,
) -> tuple[DataFrame, DataFrame]:
    """Review-feed pages (with app_name, app_id, country) to signals and their summary.

    Reviews are kept from the first day on, or for so many ``days`` before the day of ``as_of`` (default: now).
    """
    as_of = as_of or dt.datetime.now()
    first_day = first_day or as_of.date() - dt.timedelta(days=days)
    found = review_ops.since(review_ops.to_signals(feeds.review_entries(pages), **how), first_day)
    if output:
        found = materialise(found, "reviews")
    summary = review_ops.summary(found, first_day)
    if output:
        files.write_result(summary, found, f"{output}/json", "reviews")
        files.write_rows(review_ops.apps(found), f"{output}/json/apps")
        files.write_rows(feeds.review_rejects(pages), f"{output}/json/rejects")
        files.write_csv(found, f"{output}/csv")
    return found, summary


def price_benchmarks(
    sources: DataFrame, pages: DataFrame, newest: Sequence[str], output: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Sources and stored pages to price records and their summary.

    Records are stored before they are summed up: pages are parsed once.
    """
    found = materialise(benchmarks.records(sources, pages, newest), "price-records")
    summary = benchmarks.summary(found)
    if output:
        files.write_result(summary, found, f"{output}/json")
        files.write_rows(benchmarks.verified_benchmarks(found), f"{output}/json/benchmarks")
        files.write_rows(benchmarks.verified_prices(found), f"{output}/json/verified_prices")
        files.write_csv(found, f"{output}/csv")
    return found, summary


def search_interest(
    payloads: DataFrame,
    keywords: Sequence[str],
    timeframe: str = "today 24-m",
    geo: str = "TW",
    output: str | None = None,
    as_of: dt.datetime | None = None,
    collected_at: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Search-interest payloads (with keyword) to the weekly table and its summary.

    A relative timeframe ends on the day of ``as_of`` (default: now), in both tables alike.
    """
    spark = payloads.sparkSession
    timeframe = dates.timeframe(timeframe, as_of.date() if as_of else None)
    series = interest.combine(spark, [feeds.interest_points(payloads)], timeframe, geo, collected_at)
    if output:
        series = materialise(series, "interest")
    note = interest.failure_note(series, keywords)
    summary = interest.summary(series, timeframe, geo, keywords, note)
    if output:
        files.write_csv(series, f"{output}/csv")
        files.write_rows(summary, f"{output}/json")
        files.write_rows(feeds.interest_rejects(payloads), f"{output}/rejects")
    return series, summary


def evidence_report(
    spark: SparkSession,
    own_name: str,
    signals: DataFrame | None = None,
    interest_summary: DataFrame | None = None,
    review_summary: DataFrame | None = None,
    price_records: DataFrame | None = None,
    output: str | None = None,
    order: str | None = None,
    sources: dict[str, str] | None = None,
) -> DataFrame:
    """One nested report of whatever evidence there is."""
    files_ = sources or {}

    def made(frame, name, build):
        source = files_.get(name, "")
        return build(frame, source) if frame is not None else evidence.absent_section(
            spark, name, source
        )

    empty = signals if signals is not None else spark.createDataFrame([], schemas.SIGNALS)
    report = evidence.report(
        evidence.forum_section(
            signal_ops.report_summary(empty, order), files_.get("forum_summary", "")
        ),
        made(interest_summary, "search_trends_summary", evidence.interest_section),
        made(review_summary, "app_review_summary", evidence.review_section),
        made(
            price_records,
            "competitor_pricing_summary",
            lambda rows, source: evidence.price_section(
                benchmarks.report_summary(rows, own_name), source
            ),
        ),
    )
    if output:
        files.write_rows(report, output)
    return report
