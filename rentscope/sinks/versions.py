"""Stored tables whose readers see one version.

A table is a folder of loads and of commits:

- ``loads/<name>``: the rows of one load, written whole before anything refers to it;
- ``parts/<name>``: that load's manifest, a row per part file with its bytes and rows;
- ``commits/version=<n>``: one row that makes the load part of version n. A commit that replaces starts the
  table anew, any other adds to the version before.

A reader takes the commits up to its version and reads exactly the loads they name. What a lost driver or
executor left behind is named by no commit, so nobody reads it. Loads are never changed; old ones may
be deleted when no reader needs their versions any more.

A load may have a key. A key that a commit up to now already has is not loaded again, so a load that is
repeated after a crash, or after an answer was lost, adds nothing.

Writers take turns by the number of the version: of two that commit the same one, the second one to write
finds it taken and goes on to the next. Only a folder of a store that is listed consistently will do.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

COMMIT = "load string, key string, replaces boolean, rows bigint, committed_at timestamp"
ATTEMPTS = 20


class NoSuchTable(FileNotFoundError):
    """There is no committed version at a path."""


def commits(spark: SparkSession, path: str) -> DataFrame:
    """version, load, key, replaces, rows and committed_at of every commit; none if there is no table."""
    schema = COMMIT + ", version bigint"
    try:
        return spark.read.schema(schema).parquet(f"{path}/commits")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def newest(spark: SparkSession, path: str) -> int | None:
    """The number of the newest version, which pins what a reader sees; None if there is no table."""
    return commits(spark, path).agg(F.max("version")).first()[0]


def _live(spark: SparkSession, path: str, version: int | None) -> DataFrame:
    """The commits that make up a version."""
    told = commits(spark, path)
    if version is not None:
        told = told.where(F.col("version") <= version)
    start = told.where("replaces").agg(F.max("version")).first()[0]
    return told if start is None else told.where(F.col("version") >= start)


def read(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The rows of a version (default: the newest one there is now)."""
    # One name a load, not a part file. Loads are as many as calls that appended since the last replacement.
    names = sorted(row.load for row in _live(spark, path, version).select("load").collect())
    if not names:
        raise NoSuchTable(f"no version {'' if version is None else version} of a table at {path}")
    return spark.read.parquet(*(f"{path}/loads/{name}" for name in names))


def added(spark: SparkSession, path: str, since: int, version: int) -> DataFrame | None:
    """The rows that versions after ``since`` added, up to a version; None if one of them replaced the table."""
    told = commits(spark, path).where((F.col("version") > since) & (F.col("version") <= version))
    loads = told.select("load", "replaces").collect()
    if not loads or any(row.replaces for row in loads):
        return None
    return spark.read.parquet(*(f"{path}/loads/{row.load}" for row in loads))


def rows_of(spark: SparkSession, path: str, version: int | None = None) -> int:
    """How many rows a version has, by its commits."""
    return _live(spark, path, version).agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]


def parts(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The manifest of a version: load, file, bytes and rows of every part file."""
    live = _live(spark, path, version).select("load")
    told = spark.read.schema("file string, bytes bigint, rows bigint, load string").parquet(f"{path}/parts")
    return told.join(live, "load").select("load", "file", "bytes", "rows")


def damaged(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """Part files of a version that are missing or have another size than when they were committed."""
    names = [row.load for row in _live(spark, path, version).select("load").collect()]
    there = (
        spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
        .load([f"{path}/loads/{name}" for name in names])
        .select(F.element_at(F.split("path", "/"), -1).alias("file"), F.col("length").alias("found"))
    )
    told = parts(spark, path, version)
    return told.join(there, "file", "left").where("found is null or found <> bytes")


def _manifest(spark: SparkSession, path: str, name: str) -> DataFrame:
    """The part files of a load with their rows, counted from the files' own footers."""
    rows = spark.read.parquet(f"{path}/loads/{name}")
    file = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)
    return rows.groupBy(file.alias("file"), F.col("_metadata.file_size").alias("bytes")).agg(
        F.count(F.lit(1)).alias("rows")
    )


def _commit(spark: SparkSession, path: str, name: str, key: str | None, replaces: bool, rows: int) -> int:
    """The version the load got."""
    stamp = dt.datetime.now()
    for _ in range(ATTEMPTS):
        version = (newest(spark, path) or 0) + 1
        row = spark.createDataFrame([(name, key, replaces, rows, stamp)], COMMIT).coalesce(1)
        try:
            row.write.mode("error").parquet(f"{path}/commits/version={version}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_ALREADY_EXISTS":
                raise
            continue
        return version
    raise RuntimeError(f"no version of {path} could be committed in {ATTEMPTS} attempts")


def write(df: DataFrame, path: str, replace: bool = True, key: str | None = None) -> int:
    """Replace or extend a table; returns the rows of the load.

    Rows may come from the table itself. A key that was committed before changes nothing and returns
    the rows it had then. A replacement by nothing leaves an empty table with these columns.
    """
    spark = df.sparkSession
    if key is not None:
        before = commits(spark, path).where(F.col("key") == key).select("rows").first()
        if before is not None:
            return before.rows
    name, seen = uuid.uuid4().hex, Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(f"{path}/loads/{name}")
    _manifest(spark, path, name).write.parquet(f"{path}/parts/load={name}")
    rows = seen.get["rows"]
    _commit(spark, path, name, key, replace, rows)
    return rows
