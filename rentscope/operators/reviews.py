"""App reviews to complaint signals."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rentscope import vocab
from rentscope.functions import dates, text
from rentscope.operators import ranking
from rentscope.operators.metrics import one_row
from rentscope.session import materialise


def to_signals(
    reviews: DataFrame,
    collected_at: str | None = None,
    patterns: Mapping[str, str] = vocab.PAIN_POINTS,
) -> DataFrame:
    """Tag each review by title and content, and hide personal data in the content."""
    both = F.concat_ws("\n", "title", "content")
    others = [c for c in reviews.columns if c != "content"]
    return reviews.select(
        *others,
        text.mask_review(F.col("content")).alias("content_redacted"),
        text.pain_tags(both, patterns).alias("pain_keywords"),
        F.lit(collected_at or dates.utc_now()).alias("collected_at"),
    )


def since(reviews: DataFrame, first_day: dt.date) -> DataFrame:
    """Reviews whose date can be read and is not before the first day."""
    return reviews.filter(dates.review_date(F.col("updated")) >= F.lit(first_day))


def apps(reviews: DataFrame, order: str | None = None) -> DataFrame:
    """Reviews per app, as a table: rank, key and count. There may be any number of apps."""
    return ranking.numbered(ranking.tally(reviews, {"app": F.array("app_name")}, order))


def summary(reviews: DataFrame, first_day: dt.date, order: str | None = None) -> DataFrame:
    """Review count, number of apps, mean rating and top complaints, in one row."""
    counts = ranking.tally(
        reviews,
        {
            "app": F.array("app_name"),
            "pain": F.col("pain_keywords"),
            "rating": F.array("rating"),
            "review": F.array(F.lit("all")),
        },
        order,
    )
    counts = materialise(counts, "review-counts")
    stars = F.when(F.col("kind") == "rating", F.col("key").try_cast("bigint"))
    rated = F.sum(F.when(F.col("kind") == "rating", F.col("count")))
    figures = counts.agg(
        F.lit(dates.utc_now()).alias("generated_at"),
        F.lit(vocab.REVIEW_SOURCE).alias("source"),
        F.lit(first_day.isoformat()).alias("since_date"),
        ranking.counted("review", "all").alias("reviews_collected"),
        F.count_if(F.col("kind") == "app").alias("app_count"),
        F.bround(F.sum(stars * F.col("count")) / rated, 2).alias("average_rating"),
        F.lit(vocab.REVIEW_NOTE).alias("note"),
    )
    leading = ranking.leaders(counts.filter("kind = 'pain'"), 10)
    return one_row(figures, leading.agg(ranking.top("pain").alias("top_pain_keywords")))
