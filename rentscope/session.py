"""Session settings and the shared scratch area."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Lets the CSV reader decode big5 and cp950.
    "spark.sql.legacy.javaCharsets": "true",
    # Pages go to Python in batches; a page may be large, so their bytes are what counts.
    "spark.sql.execution.arrow.maxBytesPerBatch": "16m",
}


def build_session(name: str = "rentscope", master: str | None = None, **conf) -> SparkSession:
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path under the shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder of its machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        root = tempfile.mkdtemp(prefix="rentscope-")
    return f"{root.rstrip('/')}/rentscope/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write an intermediate table once and read it back.

    Cuts the lineage in reliable storage, so a lost executor costs no recomputation,
    and gives the planner the table's true size to choose a join with.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


FEW_PIECES = 64


def spread(scan: DataFrame) -> DataFrame:
    """Rows of a scan over all cores, if its files make only a few pieces.

    A piece is at most ``spark.sql.files.maxPartitionBytes`` long and at most
    ``FEW_PIECES`` of them are moved, so the moved table is small; any other is
    returned as it is.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    pieces = scan.rdd.getNumPartitions()
    return scan.repartition(cores) if pieces < min(cores, FEW_PIECES) else scan
