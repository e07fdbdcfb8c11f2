"""JSON documents and snapshots, with a default where there is none."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rentscope.sinks import versions

TRANSACTION_COLUMNS = [
    "district", "building_type", "area_ping", "rent_ntd", "rent_per_ping", "transaction_date",
]


def _exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.format("binaryFile").load(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def read_json(
    spark: SparkSession, path: str, schema: str | StructType, multi_line: bool = True
) -> DataFrame:
    """A JSON array, document or JSON Lines table; no rows if the path is missing."""
    if not _exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).json(path, multiLine=multi_line)


def read_signals(
    spark: SparkSession, default: str, schema: str, preferred: str | None = None
) -> DataFrame:
    """Signals of the preferred path if it exists, else of the default one, else an error.

    Column ``origin`` names the one that was read.
    """
    for path, origin in ((preferred, preferred), (default, "default")):
        if path and _exists(spark, path):
            rows = spark.read.schema(schema).json(path)
            return rows.withColumn("origin", F.lit(origin.rstrip("/").rsplit("/", 1)[-1]))
    raise FileNotFoundError(f"no signals at {preferred} or {default}")


def with_source_file(df: DataFrame, root: str = "") -> DataFrame:
    """The file each row came from, relative to ``root`` where it lies below it."""
    path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    if root:
        folder = root.rstrip("/") + "/"
        path = F.when(path.contains(folder), F.split_part(path, F.lit(folder), F.lit(-1))).otherwise(path)
    return df.withColumn("source_file", path)


def stored_rows(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The rows of a stored table at one version (default: the newest), or of a plain folder of Parquet files."""
    try:
        return versions.read(spark, path, version)
    except versions.NoSuchTable:
        if version is not None or _exists(spark, f"{path}/loads"):
            raise
        return spark.read.parquet(path)


def load_transactions(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The transaction columns that metrics need."""
    return stored_rows(spark, path, version).select(*TRANSACTION_COLUMNS)


def load_points(
    spark: SparkSession, path: str, keys: tuple[str, ...] = ("district",), version: int | None = None
) -> DataFrame:
    """The transaction columns that clustering needs."""
    return stored_rows(spark, path, version).select(*keys, "area_ping", "rent_per_ping")
