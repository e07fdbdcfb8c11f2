"""The four stored tables: transactions, metrics, recommendations, clusters.

The transaction table is a versioned table (sinks/versions.py): it is replaced or extended by commits.

Replacing several tables at once goes through a version: each table is written below
a new version folder, and one appended row publishes the version when all are there.
Readers take the newest published version, so they never see half a replacement.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from rentscope.operators.cleaning import normalise_transactions
from rentscope.sinks import versions

NOT_NULL = [
    "district", "building_type", "area_ping", "rent_ntd", "rent_per_ping", "transaction_date",
]
VERSION = "version string, published_at timestamp"


def transactions_table(df: DataFrame) -> DataFrame:
    """Rows of the transaction table with their ingest stamp; a missing value is an error."""
    rows = normalise_transactions(df)
    checked = {
        c: F.coalesce(c, F.raise_error(F.lit(f"{c} is missing")).cast(rows.schema[c].dataType))
        for c in NOT_NULL
    }
    return rows.withColumns(checked).withColumn("ingested_at", F.current_timestamp())


def save_transactions(df: DataFrame, path: str, replace: bool = True, key: str | None = None) -> int:
    """Replace or extend the transaction table; returns the rows written.

    A load with a key that the table already has is not written again.
    """
    return versions.write(transactions_table(df), path, replace, key)


def publish(tables: Mapping[str, DataFrame], root: str) -> dict[str, int]:
    """Write a new version of all tables, then publish it; returns rows per table."""
    version = uuid.uuid4().hex
    counts = {}
    for name, table in tables.items():
        seen = Observation()
        observed = table.observe(seen, F.count(F.lit(1)).alias("rows"))
        observed.write.parquet(f"{root}/{version}/{name}")
        counts[name] = seen.get["rows"]
        spark = table.sparkSession
    stamp = dt.datetime.now()
    spark.createDataFrame([(version, stamp)], VERSION).coalesce(1).write.mode("append").parquet(
        f"{root}/published"
    )
    return counts


def current(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A table of the newest published version."""
    published = spark.read.schema(VERSION).parquet(f"{root}/published")
    newest = published.orderBy(F.desc("published_at"), "version").first()
    return spark.read.parquet(f"{root}/{newest.version}/{name}")
