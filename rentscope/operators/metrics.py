"""Segment metrics, summaries and price bands."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rentscope.functions.numbers import confidence, half_even
from rentscope.operators import quantiles

SEGMENT = ["district", "building_type"]
BANDS = {
    "recommended_rent_low": "p25_rent_per_ping",
    "recommended_rent_mid": "median_rent_per_ping",
    "recommended_rent_high": "p75_rent_per_ping",
}


def district_metrics(
    transactions: DataFrame, max_values: int = quantiles.MAX_VALUES
) -> DataFrame:
    """Sample size and exact rent quantiles by district and building type."""
    found = quantiles.aggregate(
        transactions,
        SEGMENT,
        {
            "median_rent_per_ping": ("rent_per_ping", 0.5),
            "p25_rent_per_ping": ("rent_per_ping", 0.25),
            "p75_rent_per_ping": ("rent_per_ping", 0.75),
            "median_rent_ntd": ("rent_ntd", 0.5),
        },
        [F.count("rent_per_ping").alias("sample_size")],
        max_values,
    )
    return found.select(
        *SEGMENT, "sample_size", "median_rent_per_ping", "p25_rent_per_ping",
        "p75_rent_per_ping", "median_rent_ntd", F.current_timestamp().alias("updated_at"),
    )


def recommendations(metrics: DataFrame, area_ping: float = 10.0) -> DataFrame:
    """Low, middle and high monthly rent of each segment for one floor area."""
    bands = [half_even(F.col(unit) * area_ping).alias(name) for name, unit in BANDS.items()]
    return metrics.select(
        *SEGMENT,
        F.lit(float(area_ping)).alias("area_ping"),
        *bands,
        confidence(F.col("sample_size")).alias("confidence_score"),
        F.current_timestamp().alias("updated_at"),
    )


def find_recommendations(
    recs: DataFrame, district: str | None = None, building_type: str | None = None
) -> DataFrame:
    for name, wanted in zip(SEGMENT, (district, building_type)):
        if wanted:
            recs = recs.filter(F.col(name) == wanted)
    return recs.orderBy(*SEGMENT)


def _listing(df: DataFrame, order: Sequence[str]) -> DataFrame:
    stamp = F.date_format("updated_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return df.withColumn("updated_at", stamp).orderBy(*order)


def list_metrics(metrics: DataFrame) -> DataFrame:
    return _listing(metrics, SEGMENT)


def list_clusters(clusters: DataFrame) -> DataFrame:
    return _listing(clusters, ["cluster_id"])


def district_summary(
    rent: DataFrame, max_values: int = quantiles.MAX_VALUES
) -> DataFrame:
    """Rent, area and unit-rent figures by district, dearest first."""
    exact = {
        "median_rent_total_ntd": ("rent_total_ntd", 0.5),
        "p25_rent_total_ntd": ("rent_total_ntd", 0.25),
        "p75_rent_total_ntd": ("rent_total_ntd", 0.75),
        "median_area_ping": ("area_ping", 0.5),
        "median_rent_per_ping_ntd": ("rent_per_ping_ntd", 0.5),
    }
    others = [
        F.count("rent_total_ntd").alias("sample_size"),
        F.avg("rent_total_ntd").alias("avg_rent_total_ntd"),
        F.avg("rent_per_ping_ntd").alias("avg_rent_per_ping_ntd"),
    ]
    found = quantiles.aggregate(rent, ["district"], exact, others, max_values)
    figures = [
        "median_rent_total_ntd", "avg_rent_total_ntd", "p25_rent_total_ntd",
        "p75_rent_total_ntd", "median_area_ping", "median_rent_per_ping_ntd",
        "avg_rent_per_ping_ntd",
    ]
    return found.select(
        "district", "sample_size", *[F.bround(c, 2).alias(c) for c in figures]
    ).orderBy(F.desc("median_rent_total_ntd"), "district")


def distinct_districts(df: DataFrame) -> DataFrame:
    return df.agg(F.countDistinct("district").alias("districts"))


def options(df: DataFrame, column: str) -> DataFrame:
    """Sorted distinct values for a choice list."""
    return df.select(column).distinct().orderBy(column)


def transactions_summary(transactions: DataFrame) -> DataFrame:
    """Row count, sorted districts and newest ingest stamp, in one row.

    Rows are first reduced to one per district, so the list is built from districts.
    """
    by_district = transactions.groupBy("district").agg(
        F.count(F.lit(1)).alias("n"), F.max("ingested_at").alias("latest")
    )
    return by_district.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_transactions"),
        F.array_sort(F.collect_list("district")).alias("districts"),
        F.max("latest").alias("latest_ingested_at"),
    )


def dashboard_figures(metrics: DataFrame, recs: DataFrame, clusters: DataFrame) -> DataFrame:
    """Districts, median sample size, mean confidence and number of clusters in one row.

    Sample sizes are counted first: distinct sizes grow no faster than the square
    root of the number of transactions.
    """
    sizes = metrics.groupBy("sample_size").agg(F.count(F.lit(1)).alias("n"))
    parts = [
        metrics.agg(F.countDistinct("district").alias("districts")),
        sizes.agg(
            quantiles.of_counts("sample_size", "n", 0.5).cast("bigint").alias("median_sample_size")
        ),
        recs.agg(F.avg("confidence_score").alias("mean_confidence")),
        clusters.agg(F.count(F.lit(1)).alias("segments")),
    ]
    return one_row(*parts)


def one_row(*parts: DataFrame) -> DataFrame:
    """One-row tables side by side, without a join."""
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part, allowMissingColumns=True)
    return stacked.agg(*[F.first(c, ignorenulls=True).alias(c) for c in stacked.columns])


def rent_table(metrics: DataFrame, building_types: Sequence[str]) -> DataFrame:
    """Median unit rent with one row per district and one column per building type."""
    return (
        metrics.groupBy("district")
        .pivot("building_type", list(building_types))
        .agg(F.first("median_rent_per_ping"))
        .orderBy("district")
    )
