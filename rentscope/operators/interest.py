"""Weekly search interest by keyword."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rentscope import schemas, vocab
from rentscope.functions import dates

def combine(
    spark, series: Sequence[DataFrame], timeframe: str, geo: str, collected_at: str | None = None
) -> DataFrame:
    """All keyword series (week, keyword, interest) in one table with constant columns."""
    if not series:
        return spark.createDataFrame([], schemas.INTEREST)
    rows = reduce(DataFrame.unionByName, [s.select("week", "keyword", "interest") for s in series])
    return rows.withColumns(
        {
            "source": F.lit(vocab.INTEREST_SERIES_SOURCE),
            "timeframe": F.lit(dates.timeframe(timeframe)),
            "geo": F.lit(geo),
            "collected_at": F.lit(collected_at or dates.utc_now()),
        }
    )


def failure_note(found: DataFrame, keywords: Sequence[str]) -> str | None:
    """Which of the asked keywords have no data; None if all have some."""
    names = list(keywords)
    rows = found.filter(F.col("keyword").isin(names)).select("keyword").distinct().collect()
    present = {row.keyword for row in rows}
    missing = "; ".join(f"{k}: empty timeline" for k in names if k not in present)
    if not missing:
        return None
    return (vocab.INTEREST_PARTIAL if present else vocab.INTEREST_FAILED) + missing


FIELDS = ["keyword", "mean_interest", "max_interest", "latest_interest", "weeks_observed"]


def _stats(series: DataFrame) -> DataFrame:
    latest = F.max_by("interest", F.struct("week", "interest"))
    return series.groupBy("keyword").agg(
        F.bround(F.avg("interest"), 2).alias("mean_interest"),
        F.max("interest").alias("max_interest"),
        latest.cast("double").alias("latest_interest"),
        F.count("interest").alias("weeks_observed"),
        F.avg("interest").alias("_mean"),
    )


def stats(series: DataFrame) -> DataFrame:
    """Mean, greatest, latest interest and weeks observed by keyword, highest mean first."""
    return _stats(series).orderBy(F.desc("_mean"), "keyword").select(*FIELDS)


def summary(
    series: DataFrame,
    timeframe: str,
    geo: str,
    keywords: Sequence[str] = vocab.DEFAULT_TREND_KEYWORDS,
    note: str | None = None,
) -> DataFrame:
    """One row with the statistics of the asked keywords and the one of highest mean.

    The list is as long as ``keywords``; ``stats`` is the table of all.
    """
    rows = F.collect_list(F.struct((-F.col("_mean")).alias("_o"), *FIELDS))
    listed = F.transform(F.array_sort(rows), lambda r: F.struct(*[r[f].alias(f) for f in FIELDS]))
    return (
        _stats(series.filter(F.col("keyword").isin(list(keywords))))
        .agg(listed.alias("keyword_stats"))
        .select(
            F.lit(vocab.INTEREST_SOURCE).alias("source"),
            F.lit(vocab.INTEREST_METHOD).alias("method"),
            F.lit(dates.timeframe(timeframe)).alias("timeframe"),
            F.lit(geo).alias("geo"),
            F.array(*[F.lit(k) for k in keywords]).cast("array<string>").alias("keywords"),
            F.get("keyword_stats", F.lit(0))["keyword"].alias("top_keyword_by_mean_interest"),
            "keyword_stats",
            F.lit(note or vocab.INTEREST_NOTE).alias("note"),
            (F.size("keyword_stats") > 0).alias("available"),
        )
    )
