"""Forum articles to rent signals, and summaries of signals."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rentscope import vocab
from rentscope.functions import dates, money, text
from rentscope.functions.numbers import ratio
from rentscope.operators import quantiles, ranking
from rentscope.operators.metrics import one_row
from rentscope.session import materialise


def union_boards(boards: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), boards)


def recent(date: Column, since: dt.datetime | Column | None) -> Column:
    """Whether a post's date can be read and is not before the cutoff; true without one."""
    if since is None:
        return F.lit(True)
    return F.coalesce(dates.forum_timestamp(date) >= F.lit(since), F.lit(False))


def newest_articles(
    articles: DataFrame, per_board: int | None = None, since: dt.datetime | None = None
) -> DataFrame:
    """Each board's newest articles, every address once and its newest copy kept.

    An article is as recent as its newest copy, so older copies go before they are compared.
    """
    dated = articles.withColumn("posted_at", dates.forum_timestamp(F.col("date")))
    if since is not None:
        dated = dated.filter(F.col("posted_at") >= F.lit(since))
    kept = ranking.newest_per_key(dated, ["board", "url"], ["posted_at", "title", "content"])
    if per_board is not None:
        order = [F.col("posted_at").desc_nulls_last(), F.col("url")]
        kept = ranking.newest_per_group(kept, "board", order, per_board, ["url"])
    return kept.drop("posted_at")


def to_signals(
    articles: DataFrame,
    keywords: Mapping[str, str] = vocab.KEYWORDS,
    districts: Sequence[str] = vocab.DISTRICTS,
    question_words: str = vocab.QUESTION_WORDS,
) -> DataFrame:
    """One signal per article; further columns of the articles stay."""
    blank = F.lit("")
    title, content = F.coalesce("title", blank), F.coalesce("content", blank)
    rows = articles.withColumn("_all", F.concat(title, F.lit("\n"), content))
    rows = rows.withColumn("_gist", text.gist(F.col("_all")))
    whole, short = F.col("_all"), F.col("_gist")
    known = ("board", "title", "author", "date", "url", "content")
    others = [c for c in articles.columns if c not in known]
    return rows.select(
        *others,
        text.thread_id(F.col("url")).alias("thread_id"),
        F.coalesce("board", blank).alias("board"),
        title.alias("title"),
        "author",
        "date",
        dates.forum_timestamp(F.col("date")).alias("posted_at"),
        "url",
        text.snippet(content).alias("short_snippet"),
        text.asks_price(whole, keywords["pricing"], question_words, short=short).alias(
            "contains_pricing_question"
        ),
        text.keyword_tags(whole, keywords, districts, short).alias("keywords"),
        text.name_tags(whole, districts, short).alias("districts"),
        money.post_prices(short).alias("extracted_prices_ntd"),
        money.post_areas(short).alias("extracted_areas_ping"),
    )


def keep(
    local_only: bool,
    since: dt.datetime | None = None,
    city_names: Sequence[str] = vocab.CITY_NAMES,
) -> Column:
    """Rule for signals worth keeping: recent, about a price, and local if asked for."""
    rule = recent(F.col("date"), since) & (
        F.col("contains_pricing_question") | (F.size("extracted_prices_ntd") > 0)
    )
    if local_only:
        words = F.concat_ws(" ", "title", "short_snippet")
        named = reduce(lambda a, b: a | b, [words.contains(name) for name in city_names])
        rule = rule & ((F.size("districts") > 0) | named)
    return rule


def raw_threads(articles: DataFrame) -> DataFrame:
    """Articles with a snippet in place of their content."""
    cut = text.snippet(F.coalesce("content", F.lit("")))
    return articles.withColumn("short_snippet", cut).drop("content")


def _counts(signals: DataFrame, order: str | None) -> DataFrame:
    return ranking.tally(
        signals,
        {
            "keyword": F.col("keywords"),
            "district": F.col("districts"),
            "price": F.col("extracted_prices_ntd"),
            "board": F.array(F.nullif("board", F.lit(""))),
            "thread": F.concat(
                F.array(F.lit("all")),
                ranking.flag("asks", F.coalesce("contains_pricing_question", F.lit(False))),
                ranking.flag("tool", F.array_contains("keywords", "tool")),
            ),
        },
        order,
    ).withColumn("value", F.when(F.col("kind") == "price", F.col("key").cast("bigint")))


def report_summary(signals: DataFrame, order: str | None = None) -> DataFrame:
    """Forum figures for the evidence report, in one row and one pass over the signals.

    Tags come from short dictionaries and prices from a fixed range, so everything
    after the count works on a table of bounded size.
    """
    counts = materialise(_counts(signals, order), "signal-counts")
    threads = ranking.counted("thread", "all")
    priced = (F.col("kind") == "price") & F.col("value").between(*vocab.RENT_RANGE)
    figures = counts.agg(
        threads.alias("threads_analyzed"),
        ratio(ranking.counted("thread", "asks"), threads).alias("pricing_question_ratio"),
        quantiles.of_counts("value", "count", 0.5, priced)
        .cast("bigint")
        .alias("median_extracted_rent_ntd"),
        F.coalesce(F.sum(F.when(priced, F.col("count"))), F.lit(0)).alias("rent_mentions_observed"),
    )
    found = one_row(figures, _top_lists(counts, 10))
    return found.select(
        "threads_analyzed", "pricing_question_ratio", "top_keywords", "top_districts",
        "median_extracted_rent_ntd", "rent_mentions_observed",
    )


def _top_lists(counts: DataFrame, k: int) -> DataFrame:
    """The k top keywords and districts, in one row."""
    leading = ranking.leaders(counts.filter(F.col("kind").isin("keyword", "district")), k)
    return leading.agg(
        ranking.top("keyword").alias("top_keywords"), ranking.top("district").alias("top_districts")
    )


def boards(signals: DataFrame, order: str | None = None) -> DataFrame:
    """Signals per board, as a table: rank, key and count. There may be any number of boards."""
    return ranking.numbered(ranking.tally(signals, {"board": F.array(F.nullif("board", F.lit("")))}, order))


def overview(signals: DataFrame, order: str) -> DataFrame:
    """Forum figures with tool-seeking share, the number of boards and the first five threads.

    The boards themselves are a table (``boards``).
    """
    counts = materialise(_counts(signals, order), "signal-counts")
    threads = ranking.counted("thread", "all")
    zero = F.lit(0.0)
    figures = counts.agg(
        threads.alias("threads_analyzed"),
        F.coalesce(ratio(ranking.counted("thread", "asks"), threads), zero).alias(
            "pricing_question_ratio"
        ),
        F.coalesce(ratio(ranking.counted("thread", "tool"), threads), zero).alias(
            "tool_seeking_ratio"
        ),
        F.count_if(F.col("kind") == "board").alias("board_count"),
        quantiles.of_counts("value", "count", 0.5, F.col("kind") == "price").alias(
            "median_extracted_rent_ntd"
        ),
    )
    return one_row(figures, _top_lists(counts, 8), examples(signals, order))


def examples(signals: DataFrame, order: str, n: int = 5) -> DataFrame:
    """The first n signals as one array of short records."""
    fields = ["board", "title", "contains_pricing_question", "districts"]
    first = signals.select(order, *fields).orderBy(order).limit(n)
    listed = F.array_sort(F.collect_list(F.struct(F.col(order).alias("_o"), *fields)))
    return first.agg(
        F.transform(listed, lambda r: F.struct(*[r[f].alias(f) for f in fields])).alias(
            "example_titles"
        )
    )
