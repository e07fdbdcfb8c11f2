"""Shards by rendezvous hashing of stable record keys.

Each record scores every shard by ``-weight / ln(u)``, where u in (0, 1) is drawn from a hash
of record key and shard, and goes to the highest score. A shard's score does not depend on the
others, so one more shard only takes records, and none moves between the old ones.

Slots number a shard's records gapless from 0 in order of the key. No task sees a whole
shard: the narrow rows are dealt by ranges and stored, counted per file, and numbered file by
file behind the counts before.

Defined cases: a null text has 0 bytes; a null key is a key of its own and comes first; rows
with equal keys share a shard and have slots in order of size and checksum, then any; an empty
table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rentscope.llm.common import named
from rentscope.session import materialise

HEX_DIGITS = 13  # 52 bits, exact in a double


def score(key: Column, shard: int, weight: float) -> Column:
    digits = F.substring(F.md5(F.concat(key, F.lit(f":{shard}"))), 1, HEX_DIGITS)
    drawn = (F.conv(digits, 16, 10).cast("double") + 0.5) / float(16**HEX_DIGITS)
    return F.lit(-float(weight)) / F.ln(drawn)


def shard_of(key: Column, weights: Sequence[float]) -> Column:
    """The shard with the highest score; of equal ones, the lowest number."""
    key = F.coalesce(key.cast("string"), F.lit("null"))
    scored = [F.struct(score(key, i, w).alias("s"), F.lit(-i).alias("i")) for i, w in enumerate(weights)]
    return -F.array_max(F.array(*scored))["i"]


def shard_of_both(key: Column, weights: Sequence[float], more: float) -> tuple[Column, Column]:
    """The shard, and the shard with one more of the weight ``more``."""
    return shard_of(key, weights), shard_of(key, [*weights, more])


def assign(docs: DataFrame, weights: Sequence[float], key: str = "doc_id") -> DataFrame:
    """key, size, text_crc32, shard and grown_shard of every row."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    now, grown = shard_of_both(F.col(key), weights, sum(weights) / len(weights))
    return docs.select(
        F.col(key),
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        now.cast("int").alias("shard"),
        grown.cast("int").alias("grown_shard"),
    )


def with_slots(rows: DataFrame, key: str = "doc_id") -> DataFrame:
    """The assigned rows numbered within their shards in order of the key."""
    order = [F.col("shard"), F.col(key).asc_nulls_first(), F.col("size"), F.col("text_crc32")]
    narrow = materialise(rows, "shard-rows")
    # The last column of the range splits even rows that are equal in all others.
    tie = narrow.withColumn("_tie", F.monotonically_increasing_id())
    dealt = materialise(tie.repartitionByRange(*order, F.col("_tie")), "shard-ranges").withColumn(
        "_file", F.col("_metadata.file_name")
    )
    counts = dealt.groupBy("shard", "_file").agg(F.count(F.lit(1)).alias("_n"))
    # One row per shard and file, and a file spans few shards; names follow the ranges.
    before = Window.partitionBy("shard").orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    based = materialise(
        counts.select("shard", "_file", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base")),
        "shard-counts",
    )
    within = Window.partitionBy("shard", "_file").orderBy(*order[1:], "_tie")
    numbered = dealt.withColumn("_place", F.row_number().over(within).cast("long") - 1)
    return (
        numbered.join(based, ["shard", "_file"])
        .withColumn("slot", F.col("_base") + F.col("_place"))
        .drop("_file", "_base", "_place", "_tie")
    )


def records(docs: DataFrame, weights: Sequence[float], key: str = "doc_id") -> DataFrame:
    """shard, slot, size, text_crc32 and the whole record, as a struct, of every row.

    The record moves once, to its range of shard and key; ``write_shards`` keeps that order.
    """
    whole = F.struct(*map(named, docs.columns)).alias("record")
    text = F.coalesce(F.col("record.text").cast("string"), F.lit(""))
    rows = docs.select(whole).select(
        F.col("record")[key].alias("_key"),
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        shard_of(F.col("record")[key], weights).cast("int").alias("shard"),
        "record",
    )
    return with_slots(rows, "_key").drop("_key")


def write_shards(placed: DataFrame, folder: str) -> None:
    """Every shard's records in a folder of its own, with their slots; a shard of any size has many files."""
    placed.select("shard", "slot", "record.*").write.partitionBy("shard").parquet(folder)


def shard(docs: DataFrame, weights: Sequence[float], key: str = "doc_id") -> DataFrame:
    """Every row with its shard, its slot, and its shard if there were one more."""
    return with_slots(assign(docs, weights, key), key).withColumn("law", F.lit("key"))
