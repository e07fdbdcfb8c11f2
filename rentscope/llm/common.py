"""What several of these operators share: words, hashes, scans, and small tables in tasks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORD_GAPS = r"[\x20\x09-\x0D]+"
# Odd multipliers that spread 64-bit values.
MIX_A, MIX_B = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
SHIFT = np.uint64(33)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keyed_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the identifier and the text (null: empty) of a table, under fixed names."""
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )


def named(name: str) -> Column:
    """A column by its exact name, whatever signs are in it."""
    return F.col("`" + name.replace("`", "``") + "`")


def fresh(name: str, *tables: DataFrame) -> str:
    """The name, with marks behind it until none of the tables has it."""
    taken = {c.lower() for table in tables for c in table.columns}
    while name.lower() in taken:
        name += "_"
    return name


def let(value: Column, body) -> Column:
    """body(value) with the value computed once per row, not once per use or element."""
    return F.transform(F.array(value), body)[0]


def mix(values: np.ndarray) -> np.ndarray:
    """64-bit values spread over all bits."""
    values = (values ^ (values >> SHIFT)) * MIX_A
    values = (values ^ (values >> SHIFT)) * MIX_B
    return values ^ (values >> SHIFT)


def draws(seed: int, count: int) -> np.ndarray:
    """So many fixed odd 64-bit numbers."""
    steps = np.arange(1, count + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return mix(steps + np.uint64(seed)) | np.uint64(1)


class WordHashes(dict):
    """64-bit hashes of words, kept for the words seen lately."""

    LIMIT = 300_000

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(word) <= 64:
            if len(self) >= self.LIMIT:
                self.clear()
            self[word] = value
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def batch_of(schema: pa.Schema, columns: list) -> pa.RecordBatch:
    arrays = [pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)
