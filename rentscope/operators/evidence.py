"""The evidence report: four one-row summaries in one nested document."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rentscope.functions import dates

SECTIONS = [
    "forum_summary", "search_trends_summary", "app_review_summary", "competitor_pricing_summary",
]


def _section(summary: DataFrame, name: str, source_file: str, **cuts: int) -> DataFrame:
    """A summary as one struct column; ``cuts`` limit the length of its arrays."""
    for column, n in cuts.items():
        summary = summary.withColumn(column, F.slice(F.col(column), 1, n))
    if "available" not in summary.columns and name != "forum_summary":
        summary = summary.withColumn("available", F.lit(True))
    fields = [F.lit(source_file).alias("source_file"), *[F.col(c) for c in summary.columns]]
    return summary.select(F.struct(*fields).alias(name))


def forum_section(summary: DataFrame, source_file: str = "") -> DataFrame:
    return _section(summary, "forum_summary", source_file)


def interest_section(summary: DataFrame, source_file: str = "") -> DataFrame:
    return _section(
        summary.drop("method", "keywords"), "search_trends_summary", source_file, keyword_stats=10
    )


def review_section(summary: DataFrame, source_file: str = "") -> DataFrame:
    return _section(
        summary.drop("app_count", "generated_at"), "app_review_summary", source_file, top_pain_keywords=10
    )


def price_section(summary: DataFrame, source_file: str = "") -> DataFrame:
    return _section(summary, "competitor_pricing_summary", source_file)


def absent_section(spark, name: str, source_file: str = "") -> DataFrame:
    """Stands for a section whose input is missing."""
    row = spark.range(1)
    fields = [F.lit(source_file).alias("source_file"), F.lit(False).alias("available")]
    return row.select(F.struct(*fields).alias(name))


def report(
    forum: DataFrame,
    interest: DataFrame,
    reviews: DataFrame,
    prices: DataFrame,
    constants: Mapping[str, str] | None = None,
    generated_at: str | None = None,
) -> DataFrame:
    """The sections side by side in one row, stacked and folded instead of joined."""
    stacked = forum
    for section in (interest, reviews, prices):
        stacked = stacked.unionByName(section, allowMissingColumns=True)
    folded = stacked.agg(*[F.first(c, ignorenulls=True).alias(c) for c in SECTIONS])
    return folded.select(
        F.lit(generated_at or dates.utc_now()).alias("generated_at"),
        F.lit(False).alias("private_interviews_used"),
        *[F.lit(words).alias(name) for name, words in (constants or {}).items()],
        *SECTIONS,
    )


def listing(report_: DataFrame, array: str, head: int | None = None) -> DataFrame:
    """One of the report's arrays, such as ``forum_summary.top_districts``, as a table."""
    values = F.col(array) if head is None else F.slice(array, 1, head)
    rows = report_.select(F.posexplode(values).alias("position", "_row"))
    nested = isinstance(rows.schema["_row"].dataType, StructType)
    return rows.select("position", "_row.*" if nested else F.col("_row").alias("value")).orderBy(
        "position"
    )
