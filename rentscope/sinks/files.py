"""CSV, JSON Lines and document writers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rentscope.functions.dates import iso
from rentscope.operators import metrics as m

BOM = "\ufeff"


def flat(df: DataFrame) -> DataFrame:
    """Arrays, maps and structs as JSON text, for formats without nesting."""
    nested = (T.ArrayType, T.MapType, T.StructType)
    return df.select(
        [
            F.to_json(f.name).alias(f.name) if isinstance(f.dataType, nested) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV files that start with a UTF-8 byte order mark and a header."""
    out = flat(df)
    first = out.columns[0]
    out.withColumnRenamed(first, BOM + first).write.mode(mode).csv(
        path, header=True, escape='"', ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )


def write_rows(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """JSON Lines, null fields included."""
    df.write.mode(mode).option("ignoreNullFields", False).json(path)


def write_result(summary: DataFrame, rows: DataFrame, path: str, name: str = "records") -> None:
    """A one-row summary document and its row table, side by side."""
    write_rows(rows, f"{path}/{name}")
    write_rows(summary, f"{path}/summary")


def export_snapshots(
    metrics: DataFrame, recs: DataFrame, clusters: DataFrame, transactions: DataFrame, path: str
) -> None:
    """The ordered listings and the transaction summary with ISO time stamps."""
    latest = iso(F.col("latest_ingested_at"))
    tables = {
        "district_metrics": m.list_metrics(metrics),
        "recommendations": m.find_recommendations(recs).withColumn(
            "updated_at", iso(F.col("updated_at"))
        ),
        "clusters": m.list_clusters(clusters),
        "transactions_summary": m.transactions_summary(transactions).withColumn(
            "latest_ingested_at", latest
        ),
    }
    for name, table in tables.items():
        write_rows(table, f"{path}/{name}")
