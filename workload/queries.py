"""Registered queries: every operator over the driver's whole tables.

Arrays and nested records are written as text, time stamps as ISO text and doubles
rounded, so that results compare by value.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rentscope import schemas, vocab
from rentscope.functions import dates, money, text
from rentscope.functions.numbers import blank_missing
from rentscope.operators import (
    benchmarks, cleaning, evidence, interest, metrics, quantiles, quotes, ranking, reviews,
    segments, signals,
)
from rentscope.plans import jobs
from rentscope.session import materialise, scratch_path
from rentscope.sinks import files, versions, warehouse
from rentscope.sources import documents, feeds, html_pages, rent_csv
from rentscope.streaming import ingest as stream_ingest
from workload import tables

SINCE = dt.datetime(2019, 7, 5)
FIRST_DAY = dt.date(2024, 4, 10)
CHECKED_AT = "2026-06-14T00:00:00+00:00"
OWN_NAME = "rentpilot"
TIMEFRAME = "2024-01-01 2024-01-31"
AS_OF = dt.datetime(2026, 6, 14, 8, 30)
GEO = "TW"
EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]
BUILDING_TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
FORUM_URL = "https://forum.example"


def joined(values: Column | str, mark: str = ",") -> Column:
    values = F.col(values) if isinstance(values, str) else values
    return F.array_join(values.cast("array<string>"), mark)


def decimals(values: Column | str) -> Column:
    """Doubles of an array in hundredths, which print alike everywhere."""
    values = F.col(values) if isinstance(values, str) else values
    return joined(F.transform(values, lambda v: F.round(v * 100).cast("bigint")))


def pairs(values: Column | str) -> Column:
    values = F.col(values) if isinstance(values, str) else values
    return F.array_join(
        F.transform(values, lambda p: F.concat(p["key"], F.lit(":"), p["count"].cast("string"))), ","
    )


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def day(column: Column | str) -> Column:
    return F.date_format(column, "yyyy-MM-dd")


def moment(column: Column | str) -> Column:
    return F.date_format(column, "yyyy-MM-dd'T'HH:mm:ss")


# --- inputs ---------------------------------------------------------------------

def transactions(spark: SparkSession, sf: str) -> DataFrame:
    return tables.table(spark, sf, tables.TRANSACTIONS)


def plausible(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.plausible(transactions(spark, sf), total="rent_ntd", unit="rent_per_ping")


def raw_rent(spark: SparkSession, sf: str) -> DataFrame:
    raw = tables.table(spark, sf, tables.RAW_RENT)
    words = {f.name: blank_missing(F.col(f.name)) for f in raw.schema if f.dataType.simpleString() == "string"}
    return raw.withColumns(words)


def clean(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.clean_rent(cleaning.rental_rows(raw_rent(spark, sf)))


def requests(spark: SparkSession, sf: str) -> DataFrame:
    return tables.table(spark, sf, tables.REQUESTS)


def articles(spark: SparkSession, sf: str) -> DataFrame:
    return tables.table(spark, sf, tables.ARTICLES)


def whole_post() -> Column:
    return F.concat("title", F.lit("\n"), "content")


def posts_with_gist(spark: SparkSession, sf: str) -> DataFrame:
    rows = articles(spark, sf).withColumn("_all", whole_post())
    return rows.withColumn("_gist", text.gist(F.col("_all")))


def post_signals(spark: SparkSession, sf: str) -> DataFrame:
    return signals.to_signals(articles(spark, sf))


def review_rows(spark: SparkSession, sf: str) -> DataFrame:
    pages = feeds.with_app(tables.review_pages(spark, sf), tables.apps(spark, sf))
    found = reviews.to_signals(feeds.review_entries(pages), CHECKED_AT)
    return reviews.since(found, FIRST_DAY)


def sources(spark: SparkSession, sf: str) -> DataFrame:
    return tables.table(spark, sf, tables.PRICE_SOURCES)


def price_pages(spark: SparkSession, sf: str) -> DataFrame:
    return tables.table(spark, sf, tables.PRICE_PAGES)


def price_rows(spark: SparkSession, sf: str) -> DataFrame:
    return benchmarks.records(sources(spark, sf), price_pages(spark, sf), ["page_id"], CHECKED_AT)


def series(spark: SparkSession, sf: str) -> DataFrame:
    points = feeds.interest_points(tables.trend_payloads(spark, sf))
    by_type = [points.filter(F.col("keyword") == k) for k in EVENT_TYPES[:2]]
    rest = points.filter(~F.col("keyword").isin(EVENT_TYPES[:2]))
    return interest.combine(spark, [*by_type, rest], TIMEFRAME, GEO, CHECKED_AT)


# --- cleaning -------------------------------------------------------------------

def rental_rows(spark, sf):
    return cleaning.rental_rows(raw_rent(spark, sf)).select(
        "order_key", "line_number", "DISTRICT", "CASE_T", "RENT_TYPE", "RENT_PERIOD"
    )


def clean_rent(spark, sf):
    return clean(spark, sf).withColumn("transaction_date", day("transaction_date"))


def ingest_rows(spark, sf):
    rows = cleaning.to_ingest(clean(spark, sf))
    return rows.withColumn("transaction_date", day("transaction_date"))


def district_summary(spark, sf):
    return metrics.district_summary(clean(spark, sf))


def normalised_transactions(spark, sf):
    rows = transactions(spark, sf).select(
        "district", "building_type", "area_ping", F.col("rent_ntd").alias("rent_total_ntd"),
        F.when(F.col("rent_ntd") % 2 == 0, F.col("rent_per_ping")).alias("rent_per_ping_ntd"),
        "transaction_date",
    )
    found = cleaning.normalise_transactions(rows)
    return found.withColumn("transaction_date", day("transaction_date"))


def plausible_transactions(spark, sf):
    return plausible(spark, sf).withColumn("transaction_date", day("transaction_date"))


def rent_csv_files(spark, sf):
    """Raw rows written as UTF-8 and big5 files, read back, cleaned and summed up."""
    raw = tables.table(spark, sf, tables.RAW_RENT).drop("order_key", "line_number")
    path = scratch_path(spark, "rent-csv")
    even = F.col("ELEVATOR") == "有"
    files.write_csv(raw.filter(even), f"{path}/utf8")
    spark.conf.set("spark.sql.legacy.javaCharsets", "true")
    raw.filter(~even).write.csv(f"{path}/big5", header=True, encoding="big5")
    read = rent_csv.with_columns(
        rent_csv.read_rent_csv(spark, f"{path}/utf8", f"{path}/big5")
    )
    return metrics.district_summary(cleaning.clean_rent(cleaning.rental_rows(read)))


# --- metrics and quotes -----------------------------------------------------------

METRIC_FIGURES = [
    "median_rent_per_ping", "p25_rent_per_ping", "p75_rent_per_ping", "median_rent_ntd",
]


def district_metrics(spark, sf):
    found = metrics.district_metrics(plausible(spark, sf))
    return rounded(found.drop("updated_at"), *METRIC_FIGURES)


def narrowed_metrics(spark, sf):
    """The same figures by narrowing, as for groups too large for one task."""
    found = metrics.district_metrics(plausible(spark, sf), max_values=100)
    return rounded(found.drop("updated_at"), *METRIC_FIGURES)


def overall_quantiles(spark, sf):
    """Quantiles of the whole table as one group, by narrowing."""
    found = quantiles.aggregate(
        transactions(spark, sf),
        [],
        {
            "p25_area_ping": ("area_ping", 0.25),
            "median_rent_ntd": ("rent_ntd", 0.5),
            "p99_rent_per_ping": ("rent_per_ping", 0.99),
        },
        [F.count(F.lit(1)).alias("sample_size")],
        max_values=200,
    )
    return rounded(found, "p25_area_ping", "median_rent_ntd", "p99_rent_per_ping")


def recommendations(spark, sf):
    found = metrics.recommendations(metrics.district_metrics(plausible(spark, sf)))
    return rounded(found.drop("updated_at"), "confidence_score")


def recommendations_filtered(spark, sf):
    found = metrics.recommendations(metrics.district_metrics(plausible(spark, sf)), 12.5)
    return rounded(
        metrics.find_recommendations(found.drop("updated_at"), "NATION_3"), "confidence_score"
    )


def _quotes(spark, sf):
    found = rounded(metrics.district_metrics(plausible(spark, sf)), *METRIC_FIGURES)
    return quotes.quote(requests(spark, sf), materialise(found, "metrics"))


def batch_quotes(spark, sf):
    return _quotes(spark, sf).select(
        "request_id", "district", "building_type", "area_ping", "status",
        "recommended_rent_low", "recommended_rent_mid", "recommended_rent_high",
        "rent_per_ping_low", "rent_per_ping_mid", "rent_per_ping_high",
        "district_median_rent_ntd", F.round("confidence_score", 6).alias("confidence_score"),
        "sample_size", "currency", "data_source",
        F.col("pricing_guidance.market.monthly_rent_ntd").alias("market_rent"),
        F.col("pricing_guidance.conservative.label").alias("conservative_label"),
        F.col("annual_rent_estimate.high_ntd").alias("annual_high"),
    )


def quote_breakdown(spark, sf):
    return quotes.breakdown(_quotes(spark, sf))


def _stamped(spark, sf):
    """Transactions with an ingest stamp taken from their own date."""
    return transactions(spark, sf).withColumn(
        "ingested_at", F.col("transaction_date").cast("timestamp")
    )


def transactions_summary(spark, sf):
    return metrics.transactions_summary(_stamped(spark, sf)).select(
        "total_transactions", joined("districts").alias("districts"),
        moment("latest_ingested_at").alias("latest_ingested_at"),
    )


def district_count(spark, sf):
    return metrics.distinct_districts(plausible(spark, sf))


def dashboard_figures(spark, sf):
    rows = materialise(plausible(spark, sf), "transactions")
    found = materialise(metrics.district_metrics(rows), "metrics")
    clusters, _ = segments.segment(rows, order=F.md5("row_key"))
    figures = metrics.dashboard_figures(found, metrics.recommendations(found), clusters)
    return rounded(figures, "mean_confidence")


def rent_table(spark, sf):
    found = metrics.rent_table(metrics.district_metrics(plausible(spark, sf)), BUILDING_TYPES)
    return rounded(found, *BUILDING_TYPES)


def building_type_options(spark, sf):
    return metrics.options(plausible(spark, sf), "building_type")


def metrics_listing(spark, sf):
    found = metrics.list_metrics(metrics.district_metrics(plausible(spark, sf)))
    return rounded(found, *METRIC_FIGURES).withColumn(
        "updated_at", F.col("updated_at").rlike(r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d\.\d{6}$")
    )


# --- segments ---------------------------------------------------------------------

def feature_scaling(spark, sf):
    rows = plausible(spark, sf)
    scale = segments.scaling(rows)
    return rows.groupBy("district").agg(
        F.count(F.lit(1)).alias("n"),
        *[
            F.round(F.avg((F.col(c) - scale["mean"][i]) / scale["std"][i]), 6).alias(f"z_{c}")
            for i, c in enumerate(segments.FEATURES)
        ],
    )


def market_segments(spark, sf):
    found, _ = segments.segment(plausible(spark, sf), order=F.md5("row_key"))
    return rounded(
        found.drop("updated_at"), "centroid_area_ping", "centroid_rent_per_ping", digits=4
    )


def segment_assignments(spark, sf):
    _, assigned = segments.segment(plausible(spark, sf), order=F.md5("row_key"))
    return assigned.groupBy("district", "cluster_id").agg(F.count(F.lit(1)).alias("n"))


def stored_segments(spark, sf):
    """Segments of the points loaded from a stored table."""
    path = scratch_path(spark, "points")
    plausible(spark, sf).write.parquet(path)
    points = documents.load_points(spark, path, ("row_key",))
    found, _ = segments.segment(points, order=F.md5("row_key"))
    return rounded(
        found.drop("updated_at"), "centroid_area_ping", "centroid_rent_per_ping", digits=4
    )


# --- posts --------------------------------------------------------------------------

def post_tags(spark, sf):
    whole, short = F.col("_all"), F.col("_gist")
    return posts_with_gist(spark, sf).select(
        "doc_id",
        joined(text.keyword_tags(whole, short=short)).alias("keywords"),
        joined(text.name_tags(whole, short=short)).alias("districts"),
        text.asks_price(whole, short=short).alias("asks_price"),
    )


def word_tags(spark, sf):
    """Tags by Latin-script dictionaries over the bare documents."""
    patterns = {"article": "the|les|das", "ending": "tion|ing", "number": "[0-9]{3}"}
    body = F.col("text")
    return tables.base(spark, sf, "documents").select(
        "doc_id",
        joined(text.keyword_tags(body, patterns, ["and", "Is", "que"])).alias("keywords"),
        text.asks_price(body, "price|the", "what|with", "[!?]").alias("asks_price"),
    )


def post_prices(spark, sf):
    return posts_with_gist(spark, sf).select("doc_id", joined(money.post_prices(F.col("_gist"))).alias("prices"))


def post_areas(spark, sf):
    return posts_with_gist(spark, sf).select("doc_id", decimals(money.post_areas(F.col("_gist"))).alias("areas"))


def post_snippets(spark, sf):
    return signals.raw_threads(articles(spark, sf)).select(
        "doc_id", "board", text.thread_id(F.col("url")).alias("thread_id"), "short_snippet"
    )


def redacted_posts(spark, sf):
    return articles(spark, sf).select(
        "doc_id", text.mask_post(F.concat(whole_post(), F.lit(" Line ID：abc.def_1"))).alias("masked")
    )


def post_dates(spark, sf):
    return articles(spark, sf).select(
        "doc_id", moment(dates.forum_timestamp(F.col("date"))).alias("posted_at"),
        signals.recent(F.col("date"), SINCE).alias("recent"),
    )


def newest_articles(spark, sf):
    found = signals.newest_articles(articles(spark, sf), per_board=10, since=SINCE)
    return found.select("board", "url", "doc_id", "date")


def articles_once(spark, sf):
    dated = articles(spark, sf).withColumn("posted_at", dates.forum_timestamp(F.col("date")))
    return ranking.newest_per_key(dated, ["board", "url"], ["posted_at", "doc_id"]).select(
        "board", "url", "doc_id"
    )


def _signal_view(found: DataFrame) -> DataFrame:
    return found.select(
        "doc_id", "thread_id", "board", "title", moment("posted_at").alias("posted_at"),
        "short_snippet", "contains_pricing_question", joined("keywords").alias("keywords"),
        joined("districts").alias("districts"), joined("extracted_prices_ntd").alias("prices"),
        decimals("extracted_areas_ping").alias("areas"),
    )


def kept_signals(spark, sf):
    rows = articles(spark, sf)
    boards = [rows.filter(F.col("board") < "src5"), rows.filter(F.col("board") >= "src5")]
    return _signal_view(jobs.forum_signals(boards, per_board=10, local_only=True, since=SINCE))


def recent_signals(spark, sf):
    """Signals of the two years before a given time."""
    rows = articles(spark, sf)
    as_of = SINCE + dt.timedelta(days=vocab.POST_DAYS)
    return _signal_view(jobs.forum_signals([rows], per_board=10, days=vocab.POST_DAYS, as_of=as_of))


def top_tags(spark, sf):
    counts = ranking.tally(
        post_signals(spark, sf),
        {"keyword": F.col("keywords"), "district": F.col("districts"), "board": F.array("board")},
        "doc_id",
    )
    return ranking.top_keys(counts, 10)


def forum_summary(spark, sf):
    found = signals.report_summary(post_signals(spark, sf), "doc_id")
    return found.withColumns(
        {"top_keywords": pairs("top_keywords"), "top_districts": pairs("top_districts")}
    )


def listed(ranks: DataFrame, name: str) -> DataFrame:
    """A table of ranks as one text, to compare it whole."""
    rows = F.array_sort(F.collect_list(F.struct("rank", "key", "count")))
    return ranks.agg(pairs(rows).alias(name))


def forum_overview(spark, sf):
    read = ["doc_id", "board", "title", "contains_pricing_question", "keywords", "districts", "extracted_prices_ntd"]
    rows = materialise(post_signals(spark, sf).select(*read), "signals")
    found = metrics.one_row(
        signals.overview(rows, "doc_id").drop("board_count"), listed(signals.boards(rows, "doc_id"), "boards")
    )
    examples = F.transform(
        "example_titles",
        lambda r: F.concat_ws(
            "/", r["board"], r["title"], r["contains_pricing_question"].cast("string"),
            F.array_join(r["districts"], "+"),
        ),
    )
    return found.withColumns(
        {
            "top_keywords": pairs("top_keywords"),
            "top_districts": pairs("top_districts"),
            "example_titles": F.array_join(examples, ";"),
        }
    )


# --- reviews ------------------------------------------------------------------------

def review_signals(spark, sf):
    return review_rows(spark, sf).withColumn("pain_keywords", joined("pain_keywords"))


def rejected_pages(spark, sf):
    """Feed pages with broken, foreign and empty payloads: how many of each, and what is still read."""
    pages = feeds.with_app(tables.review_pages(spark, sf), tables.apps(spark, sf))
    whole = F.col("payload")
    broken = (
        F.when(~whole.contains("im:rating"), F.substring("payload", 1, 40))
        .when(whole.contains('"title":{"label":"ok"}'), F.lit('{"other": 1}'))
        .when(whole.contains('"updated":{"label":"yesterday"}'), F.lit('{"feed": {"entry": "text"}}'))
        .when(whole.contains('"title":{"label":"租金太貴"}'), F.lit(None).cast("string"))
        .otherwise(whole)
    )
    pages = materialise(pages.withColumn("payload", broken), "feed-pages")
    found = feeds.review_rejects(pages).groupBy("app_name", "reason").agg(F.count(F.lit(1)).alias("n"))
    read = feeds.review_entries(pages).groupBy("app_name").agg(F.count(F.lit(1)).alias("n"))
    return found.unionByName(read.withColumn("reason", F.lit("read")))


def rejected_payloads(spark, sf):
    """Search-interest payloads cut off after their guard or without a timeline, and those that are read."""
    rows = tables.trend_payloads(spark, sf)
    whole = F.col("payload")
    cut = F.when(whole.contains('"hasData":false'), F.substring("payload", 1, 20))
    cut = cut.when(whole.contains('"value":[]'), F.lit("{}")).otherwise(whole)
    rows = materialise(rows.withColumn("payload", cut), "payloads")
    rejects = feeds.interest_rejects(rows).groupBy("keyword").agg(F.count(F.lit(1)).alias("rejected"))
    all_ = rows.groupBy("keyword").agg(F.count(F.lit(1)).alias("payloads"))
    return all_.join(rejects, "keyword", "left").select(
        "keyword", "payloads", F.coalesce("rejected", F.lit(0)).cast("bigint").alias("rejected")
    )


def recent_reviews(spark, sf):
    """Reviews of the two years before a given time."""
    pages = feeds.with_app(tables.review_pages(spark, sf), tables.apps(spark, sf))
    as_of = dt.datetime.combine(FIRST_DAY, dt.time(13, 30)) + dt.timedelta(days=vocab.REVIEW_DAYS)
    found, _ = jobs.review_signals(pages, as_of=as_of, collected_at=CHECKED_AT)
    return found.withColumn("pain_keywords", joined("pain_keywords"))


def review_summary(spark, sf):
    rows = materialise(review_rows(spark, sf), "reviews")
    found = reviews.summary(rows, FIRST_DAY).drop("generated_at", "note", "app_count")
    return metrics.one_row(found, listed(reviews.apps(rows), "apps_reviewed")).withColumn(
        "top_pain_keywords", pairs("top_pain_keywords")
    )


def review_files(spark, sf):
    """The review job with its files, and the written rows read back."""
    path = scratch_path(spark, "reviews")
    pages = feeds.with_app(tables.review_pages(spark, sf), tables.apps(spark, sf))
    found, _ = jobs.review_signals(pages, FIRST_DAY, path, collected_at=CHECKED_AT)
    read = documents.read_json(spark, f"{path}/json/reviews", found.schema, multi_line=False)
    return read.withColumn("pain_keywords", joined("pain_keywords"))


# --- pages and prices -----------------------------------------------------------------

def page_text(spark, sf):
    return html_pages.page_text(tables.base(spark, sf, "pages").select("page_id", "html"))


def page_numbers(spark, sf):
    read = html_pages.page_text(price_pages(spark, sf).select("page_id", "html"))
    return read.select(
        "page_id",
        joined(money.page_prices(F.col("page_text"))).alias("prices"),
        decimals(money.page_percents(F.col("page_text"))).alias("percents"),
        text.price_snippet(F.col("page_text")).alias("snippet"),
    )


def document_numbers(spark, sf):
    """Page price and percent patterns over the bare documents."""
    return tables.base(spark, sf, "documents").select(
        "doc_id",
        joined(money.page_prices(F.col("text"))).alias("prices"),
        decimals(money.page_percents(F.col("text"))).alias("percents"),
    )


def price_records(spark, sf):
    return price_rows(spark, sf).withColumns(
        {
            "extracted_price_values_ntd": joined("extracted_price_values_ntd"),
            "extracted_percent_values": decimals("extracted_percent_values"),
        }
    )


def price_files(spark, sf):
    """The price job with its files, and the written records read back."""
    path = scratch_path(spark, "prices")
    found, _ = jobs.price_benchmarks(sources(spark, sf), price_pages(spark, sf), ["page_id"], path)
    read = documents.read_json(spark, f"{path}/json/records", found.schema, multi_line=False)
    return read.drop("checked_at").withColumns(
        {
            "extracted_price_values_ntd": joined("extracted_price_values_ntd"),
            "extracted_percent_values": decimals("extracted_percent_values"),
        }
    )


def verified_benchmarks(spark, sf):
    return benchmarks.verified_benchmarks(price_rows(spark, sf))


def price_products(spark, sf):
    return benchmarks.products(benchmarks.incumbents(price_rows(spark, sf), OWN_NAME))


def price_summary(spark, sf):
    rows = materialise(price_rows(spark, sf), "price-records")
    verified = benchmarks.verified_prices(rows).agg(F.sort_array(F.collect_list("price_ntd")).alias("verified"))
    return metrics.one_row(benchmarks.summary(rows), verified).select(
        "pages_checked", F.col("product_count").cast("int").alias("products"),
        F.col("benchmark_count").cast("int").alias("benchmarks"),
        joined("price_values_observed_ntd").alias("prices"),
        joined("verified").alias("verified_prices"),
        decimals("percent_values_observed").alias("percents"),
    )


def _price_report_view(found: DataFrame, at: str = "") -> DataFrame:
    return found.select(
        F.col(f"{at}pages_checked").alias("pages_checked"),
        F.col(f"{at}product_count").cast("int").alias("products"),
        F.col(f"{at}benchmark_count").cast("int").alias("benchmarks"),
        joined(f"{at}candidate_price_values_ntd").alias("candidates"),
        F.col(f"{at}median_monthly_like_price_ntd").alias("median_price"),
    )


def price_report(spark, sf):
    rows = materialise(price_rows(spark, sf), "price-records")
    return _price_report_view(benchmarks.report_summary(rows, OWN_NAME))


def index_pages(spark, sf):
    """Index pages made from the articles, one entry each, read back into rows."""
    gone = F.col("doc_id") % 5 == 0
    link = F.concat(F.lit('<a href="'), F.substr("url", F.lit(len(FORUM_URL) + 1)), F.lit('">'),
                    F.col("title"), F.lit("</a>"))
    page = F.concat(
        F.lit('<html><body><div class="btn-group btn-group-paging"><a class="btn wide" href="/old">'
              '最舊</a><a class="btn wide" href="/bbs/p'), F.col("doc_id").cast("string"),
        F.lit('.html">&lsaquo; 上頁</a></div><div class="r-ent"><div class="nrec"></div>'
              '<div class="title">\n'),
        F.when(gone, F.lit("(本文已被刪除)")).otherwise(link),
        F.lit('\n</div><div class="meta"><div class="author">'), F.col("author"),
        F.lit('</div><div class="date"> '), F.col("date"), F.lit("</div></div></div></body></html>"),
    )
    pages = articles(spark, sf).select("doc_id", "board", page.alias("html"))
    return html_pages.index_rows(pages, FORUM_URL)


def post_pages(spark, sf):
    """Post pages made from the articles, read back into masked articles."""
    body = F.replace(F.replace("content", F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    header = [
        F.concat(F.lit('<div class="article-metaline"><span class="article-meta-tag">T</span>'
                       '<span class="article-meta-value">'), value, F.lit("</span></div>"))
        for value in (F.col("author"), F.col("board"), F.lit(" 標題 "))
    ]
    page = F.concat(
        F.lit('<html><body><div id="main-content" class="bbs-screen">'),
        F.when(F.col("doc_id") % 3 == 0, F.lit("")).otherwise(F.concat(*header)),
        body,
        F.lit('\n-- \nsignature\n<span class="f2">※ 發信站: here</span>'
              '<div class="push"><span>reply</span></div></div></body></html>'),
    )
    pages = articles(spark, sf).select("doc_id", "title", "date", "url", page.alias("html"))
    return html_pages.posts(pages).select("doc_id", "author", "board", "title", "date", "content")


# --- interest --------------------------------------------------------------------------

def interest_series(spark, sf):
    return series(spark, sf).withColumn("week", day("week"))


def relative_interest(spark, sf):
    """The weekly table of a window that ends on the day of a given time."""
    found, _ = jobs.search_interest(
        tables.trend_payloads(spark, sf), EVENT_TYPES, "today 12-m", GEO, as_of=AS_OF, collected_at=CHECKED_AT
    )
    return found.withColumn("week", day("week"))


def interest_stats(spark, sf):
    return interest.stats(series(spark, sf))


def _interest_view(found: DataFrame) -> DataFrame:
    stats = F.transform(
        "keyword_stats",
        lambda s: F.concat_ws(":", s["keyword"], s["max_interest"], s["weeks_observed"]),
    )
    return found.withColumns({"keyword_stats": F.array_join(stats, ","), "keywords": joined("keywords")})


def interest_summary(spark, sf):
    return _interest_view(interest.summary(series(spark, sf), TIMEFRAME, GEO, EVENT_TYPES))


def interest_files(spark, sf):
    """The interest job, asked for one keyword without data, and its files read back."""
    path = scratch_path(spark, "interest")
    _, summary = jobs.search_interest(
        tables.trend_payloads(spark, sf), [*EVENT_TYPES, "nothing"], TIMEFRAME, GEO, path
    )
    read = documents.read_json(spark, f"{path}/json", summary.schema, multi_line=False)
    rows = spark.read.csv(f"{path}/csv", header=True, escape='"')
    return metrics.one_row(_interest_view(read), rows.agg(F.count(F.lit(1)).alias("csv_rows")))


# --- report ------------------------------------------------------------------------------

def _report(spark, sf, **how):
    rows = materialise(price_rows(spark, sf), "price-records")
    return jobs.evidence_report(
        spark, OWN_NAME, post_signals(spark, sf),
        interest.summary(series(spark, sf), TIMEFRAME, GEO, EVENT_TYPES),
        reviews.summary(review_rows(spark, sf), FIRST_DAY), rows, order="doc_id", **how,
    )


def evidence_report(spark, sf):
    found = _report(spark, sf)
    price = "competitor_pricing_summary."
    return found.select(
        "private_interviews_used",
        "forum_summary.threads_analyzed",
        "forum_summary.pricing_question_ratio",
        pairs("forum_summary.top_keywords").alias("top_keywords"),
        "forum_summary.median_extracted_rent_ntd",
        "forum_summary.rent_mentions_observed",
        "search_trends_summary.top_keyword_by_mean_interest",
        F.size("search_trends_summary.keyword_stats").alias("keywords"),
        "app_review_summary.reviews_collected",
        "app_review_summary.average_rating",
        pairs("app_review_summary.top_pain_keywords").alias("top_pain_keywords"),
        F.col(f"{price}pages_checked").alias("pages_checked"),
        joined(f"{price}candidate_price_values_ntd").alias("candidates"),
        F.col(f"{price}median_monthly_like_price_ntd").alias("median_price"),
    )


def report_districts(spark, sf):
    """The report written as a document, read back, and one of its lists as a table."""
    path = scratch_path(spark, "report")
    stored = _report(spark, sf, output=path)
    read = documents.read_json(spark, path, stored.schema, multi_line=False)
    return evidence.listing(read, "forum_summary.top_districts")


def report_head(spark, sf):
    """The first three of the districts the report names most."""
    section = evidence.forum_section(signals.report_summary(post_signals(spark, sf), "doc_id"))
    return evidence.listing(section, "forum_summary.top_districts", head=3)


# --- stored tables ----------------------------------------------------------------------

def stored_transactions(spark, sf):
    """Transactions replaced, then extended by a load that comes twice, and read while a later one is pending."""
    path = scratch_path(spark, "transactions")
    rows = transactions(spark, sf).drop("row_key")
    warehouse.save_transactions(rows, path)
    for _ in range(2):
        warehouse.save_transactions(rows.filter("area_ping < 10"), path, replace=False, key="small")
    pinned = versions.newest(spark, path)
    rows.filter("area_ping >= 10").write.parquet(f"{path}/loads/pending")
    warehouse.save_transactions(rows.filter("area_ping < 20"), path)
    read = documents.load_transactions(spark, path, pinned)
    return read.groupBy("district", "building_type").agg(
        F.count(F.lit(1)).alias("n"), F.sum("rent_ntd").alias("rent_ntd"),
        F.round(F.sum("rent_per_ping"), 2).alias("rent_per_ping"),
        day(F.max("transaction_date")).alias("latest"),
    )


def appended_metrics(spark, sf):
    """Metrics refreshed after each of three loads of the stored table; each refresh reads its load alone."""
    root = scratch_path(spark, "refreshed")
    rows = plausible(spark, sf).drop("row_key")
    third = F.pmod(F.xxhash64("transaction_date", "rent_ntd"), F.lit(3))
    for k in range(3):
        warehouse.save_transactions(rows.filter(third == k), f"{root}/table", replace=k == 0, key=f"load-{k}")
        jobs.refresh_metrics(spark, f"{root}/table", f"{root}/counts", f"{root}/published")
    found = warehouse.current(spark, f"{root}/published", "district_metrics")
    return rounded(found.drop("updated_at"), *METRIC_FIGURES)


def metrics_pipeline(spark, sf):
    """Stored transactions to metrics, bands and clusters, published together."""
    root = scratch_path(spark, "warehouse")
    warehouse.save_transactions(plausible(spark, sf).drop("row_key"), f"{root}/transactions")
    counts = jobs.run_metrics(documents.load_transactions(spark, f"{root}/transactions"), root)
    recs = warehouse.current(spark, root, "pricing_recommendations")
    sized = warehouse.current(spark, root, "rental_clusters").agg(
        F.sum("sample_size").alias("clustered")
    )
    found = recs.agg(
        F.count(F.lit(1)).alias("recommendations"),
        F.sum("recommended_rent_mid").alias("mid_rents"),
        F.lit(counts["transactions"]).cast("bigint").alias("transactions"),
        F.lit(counts["kmeans_clusters"]).cast("bigint").alias("clusters"),
    )
    return metrics.one_row(found, sized)


def snapshots(spark, sf):
    """The exported listings, read back and put together."""
    path = scratch_path(spark, "snapshots")
    rows = materialise(plausible(spark, sf), "transactions")
    found = materialise(metrics.district_metrics(rows), "metrics")
    clusters, _ = segments.segment(rows, order=F.md5("row_key"))
    files.export_snapshots(
        found, metrics.recommendations(found), clusters, _stamped(spark, sf), path
    )

    def read(name, schema):
        return documents.read_json(spark, f"{path}/{name}", schema, multi_line=False)

    recs = read("recommendations", schemas.RECOMMENDATIONS).agg(
        F.count(F.lit(1)).alias("recommendations"), F.sum("recommended_rent_high").alias("high_rents")
    )
    sized = read("clusters", schemas.CLUSTERS).agg(F.sum("sample_size").alias("clustered"))
    summary = read("transactions_summary", schemas.TRANSACTIONS_SUMMARY).select(
        "total_transactions", F.size("districts").alias("districts")
    )
    absent = read("missing", schemas.METRICS).agg(F.count(F.lit(1)).alias("absent_rows"))
    return metrics.one_row(recs, sized, summary, absent)


def signal_files(spark, sf):
    """Signals written as JSON Lines and CSV; the JSON read back, tags still arrays."""
    path = scratch_path(spark, "signals")
    jobs.forum_signals([articles(spark, sf)], per_board=None, local_only=False, output=path)
    read = documents.read_signals(
        spark, f"{path}/signals", "doc_id bigint, " + schemas.SIGNALS, f"{path}/better"
    )
    csv = spark.read.csv(f"{path}/signals_csv", header=True, escape='"', multiLine=True).select(
        F.col("doc_id").cast("bigint"), F.col("keywords").alias("keywords_json")
    )
    return read.join(csv, "doc_id").select(
        "doc_id", joined("keywords").alias("keywords"), "keywords_json",
        joined("extracted_prices_ntd").alias("prices"), "origin",
    )


def loaded_open_data(spark, sf):
    """Raw rows cleaned, written as CSV files and loaded, with what the job tells."""
    path = scratch_path(spark, "open-data")
    told = jobs.clean_and_load(raw_rent(spark, sf), path, f"{path}/table")
    table = documents.load_transactions(spark, f"{path}/table").agg(
        F.count(F.lit(1)).alias("stored"), F.sum("rent_ntd").alias("rent_ntd")
    )
    csv = rent_csv.read_ingest_csv(spark, told["ingest_csv"]).agg(
        F.count(F.lit(1)).alias("csv_rows"),
        F.lit(told["ingested"]).cast("bigint").alias("ingested"),
        F.lit(told["districts"]).cast("bigint").alias("districts"),
    )
    return metrics.one_row(table, csv)


def price_source_files(spark, sf):
    """The source list written by plan, read back with its file of origin."""
    path = scratch_path(spark, "sources")
    rows = sources(spark, sf)
    rows.withColumn("folder", F.col("pricing_plan_name")).write.partitionBy("folder").json(path)
    read = documents.read_json(spark, path, schemas.PRICE_SOURCES, multi_line=False)
    named = documents.with_source_file(benchmarks.enabled(read), path)
    folder = F.split_part("source_file", F.lit("/"), F.lit(1))
    return named.groupBy(folder.alias("folder")).agg(
        F.count(F.lit(1)).alias("n"), F.count("product").alias("named"),
        F.sum("manual_verified_price_ntd").alias("verified"),
    )


def streamed_transactions(spark, sf):
    """Ingest files appended as a stream, in two calls, and summed up."""
    path = scratch_path(spark, "stream")
    rows = transactions(spark, sf).drop("row_key").withColumn("source", F.lit("stream"))
    early = F.col("transaction_date") < "2000-01-01"
    for part in (rows.filter(early), rows.filter(~early)):
        part.write.mode("append").csv(f"{path}/in", header=True)
        stream_ingest.append_new_files(spark, f"{path}/in", f"{path}/table", f"{path}/progress")
    return documents.stored_rows(spark, f"{path}/table").groupBy("district").agg(
        F.count(F.lit(1)).alias("n"), F.sum("rent_ntd").alias("rent_ntd")
    )


QUERIES = {
    name: globals()[name]
    for name in (
        "rental_rows clean_rent ingest_rows district_summary normalised_transactions "
        "plausible_transactions rent_csv_files district_metrics narrowed_metrics "
        "overall_quantiles recommendations recommendations_filtered batch_quotes "
        "quote_breakdown transactions_summary district_count dashboard_figures rent_table "
        "building_type_options metrics_listing feature_scaling market_segments "
        "segment_assignments post_tags word_tags post_prices post_areas post_snippets "
        "redacted_posts post_dates newest_articles articles_once kept_signals top_tags "
        "forum_summary forum_overview review_signals review_summary page_text page_numbers "
        "document_numbers price_records verified_benchmarks price_products price_summary price_report "
        "index_pages post_pages interest_series interest_stats interest_summary "
        "evidence_report report_districts loaded_open_data price_source_files stored_transactions metrics_pipeline snapshots "
        "signal_files streamed_transactions review_files price_files interest_files "
        "stored_segments report_head appended_metrics recent_signals recent_reviews relative_interest "
        "rejected_pages rejected_payloads"
    ).split()
}
