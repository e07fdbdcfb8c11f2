"""Segment metrics that are kept up to date from counts of values.

A stored tally has one row for each segment, column and different value, with the number of rows that have
it. New rows are tallied alone and added to it; exact quantiles are read from it by running counts. So a
refresh after an append reads the new rows and the tally, not the rows that were there before.

Running counts are taken over ranges of (segment, column, value): within a range, behind the sums of the ranges
before. No task holds a whole segment, so one segment may have any share of the values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from rentscope.operators.metrics import SEGMENT
from rentscope.session import materialise
from rentscope.sinks import versions

COLUMNS = ("rent_per_ping", "rent_ntd")
KEYS = [*SEGMENT, "name"]
WANTED = {
    "median_rent_per_ping": ("rent_per_ping", 0.5),
    "p25_rent_per_ping": ("rent_per_ping", 0.25),
    "p75_rent_per_ping": ("rent_per_ping", 0.75),
    "median_rent_ntd": ("rent_ntd", 0.5),
}


def tally(transactions: DataFrame) -> DataFrame:
    """district, building_type, name, value and n; a null value counts rows without one."""
    cells = F.array(
        *[F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("value")) for c in COLUMNS]
    )
    rows = transactions.dropna(subset=SEGMENT).select(*SEGMENT, F.inline(cells))
    return rows.groupBy(*KEYS, "value").agg(F.count(F.lit(1)).alias("n"))


def merged(*tallies: DataFrame) -> DataFrame:
    both = tallies[0]
    for more in tallies[1:]:
        both = both.unionByName(more)
    return both.groupBy(*KEYS, "value").agg(F.sum("n").alias("n"))


def running(counts: DataFrame) -> DataFrame:
    """The tally without nulls, with the number of smaller values (``before``) of each value."""
    order = [F.col(c) for c in (*KEYS, "value")]
    dealt = materialise(counts.where("value is not null").repartitionByRange(*order), "value-ranges")
    dealt = dealt.withColumn("_file", F.col("_metadata.file_name"))
    parts = dealt.groupBy(*KEYS, "_file").agg(F.sum("n").alias("_n"), F.min("value").alias("_least"))
    # One row for each segment, column and range; a segment is in few ranges.
    earlier = W.partitionBy(*KEYS).orderBy("_least").rowsBetween(W.unboundedPreceding, -1)
    based = materialise(
        parts.select(*KEYS, "_file", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_base")), "value-bases"
    )
    within = W.partitionBy(*KEYS, "_file").orderBy("value").rowsBetween(W.unboundedPreceding, -1)
    placed = dealt.withColumn("_inside", F.coalesce(F.sum("n").over(within), F.lit(0)))
    placed = placed.join(based, [*KEYS, "_file"])
    return placed.select(*KEYS, "value", "n", (F.col("_base") + F.col("_inside")).alias("before"))


def metrics(counts: DataFrame) -> DataFrame:
    """Sample size and exact rent quantiles by district and building type, from a tally."""
    sizes = counts.groupBy(*SEGMENT).agg(
        *[
            F.coalesce(
                F.sum(F.when((F.col("name") == c) & F.col("value").isNotNull(), F.col("n"))), F.lit(0)
            ).alias(f"_n_{c}")
            for c in COLUMNS
        ]
    )
    sizes = materialise(sizes, "value-sizes")
    rows = running(counts).join(sizes, SEGMENT)
    points = []
    for name, (column, p) in WANTED.items():
        rank = (F.col(f"_n_{column}") - 1) * F.lit(p)
        ends = []
        for end in (F.floor(rank), F.ceil(rank)):
            here = (F.col("name") == column) & (F.col("before") <= end) & (end < F.col("before") + F.col("n"))
            ends.append(F.max(F.when(here, F.col("value"))))
        part = F.max(rank) - F.floor(F.max(rank))
        # A rank that is whole takes its value as it is; 0 * infinity would be NaN.
        points.append(F.when(part == 0, ends[0]).otherwise(ends[0] * (1 - part) + ends[1] * part).alias(name))
    found = rows.groupBy(*SEGMENT).agg(*points)
    return sizes.join(found, SEGMENT, "left").select(
        *SEGMENT, F.col("_n_rent_per_ping").alias("sample_size"), *WANTED, F.current_timestamp().alias("updated_at")
    )


def refresh(spark: SparkSession, table: str, state: str) -> DataFrame:
    """The tally of the newest version of a stored transaction table, brought up to date.

    ``state`` is a versioned table; each of its commits has the table's version as key. After appends only the
    loads since then are read; after a replacement all rows are. A refresh that is repeated changes nothing.
    """
    version = versions.newest(spark, table)
    if version is None:
        raise versions.NoSuchTable(f"no table at {table}")
    last = versions.commits(spark, state).orderBy(F.desc("version")).select("key").first()
    known = int(last.key) if last else None
    if known == version:
        return versions.read(spark, state)
    new = versions.added(spark, table, known, version) if known is not None else None
    if new is None:
        counts = tally(versions.read(spark, table, version))
    else:
        counts = merged(versions.read(spark, state), tally(new))
    versions.write(counts, state, key=str(version))
    return versions.read(spark, state)
