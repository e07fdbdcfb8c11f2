"""Append mode for files that arrive over time.

The batch operators are plain DataFrame functions, so a stream of new ingest files
goes through the same ones; each file is appended exactly once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rentscope.sinks.warehouse import save_transactions

INGEST_FILE = (
    "district string, building_type string, area_ping double, rent_ntd bigint, "
    "rent_per_ping double, transaction_date date, source string"
)


def append_new_files(
    spark: SparkSession, folder: str, path: str, progress: str, schema: str = INGEST_FILE
) -> None:
    """Append every ingest CSV that is new since the last call.

    A file whose header does not name the columns of ``schema`` in that order is an error.

    ``progress`` is the query's checkpoint folder, on shared storage like the table. A batch is committed to
    the table under its number, so one that is repeated after a crash adds nothing.
    """
    files = spark.readStream.schema(schema).csv(folder, header=True, enforceSchema=False, escape='"')

    def append(batch: DataFrame, number: int) -> None:
        save_transactions(batch, path, replace=False, key=f"{progress}#{number}")

    query = (
        files.writeStream.foreachBatch(append)
        .option("checkpointLocation", progress)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
