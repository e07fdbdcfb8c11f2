"""From raw documents to packed sequences: rules, exact, near and passage duplicates, packing.

Each stage works on all rows that the one before kept. Defined cases: null and repeated doc_ids are rows like
any other; a null text has no words, so the rules reject it; further columns go along unchanged up to the last
stage, whatever their names; from an empty table comes an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rentscope.llm import exact_dedup, near_dedup, packing, quality_rules, substring_dedup
from rentscope.llm.common import read_table
from rentscope.llm.queries import BYTE_BPE, PACKING_END, tokenizer
from rentscope.session import materialise


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules and whose host is not rejected; without a host the rules decide alone.

    Rejected: fewer than 20 words (null and empty texts too), more than 30 percent of them in repeated windows.
    """
    return quality_rules.keep_good(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts: that with the largest doc_id, of equal ones any."""
    return exact_dedup.keep_one(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by near duplicates of five-word shingles: the first by doc_id, nulls last.

    Texts of fewer than five words are one shingle.
    """
    return near_dedup.keep_one(docs, size=near_dedup.SHINGLE)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the words of every 35-word window that occurs more than once.

    A text that loses words becomes its other words joined by a space, empty if there are none; others stay as
    they are, and so do null texts.
    """
    return substring_dedup.strip(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their sequences; an empty text is one piece with the end id alone.

    Ids are told by their checksum here; ``packing.pack(..., with_ids=True)`` and ``packing.sequences`` give
    them whole.
    """
    return packing.pack(docs, tokenizer(BYTE_BPE), PACKING_END)


STAGES = [
    ("quality_rules", quality),
    ("exact_dedup", exact),
    ("near_dedup", near),
    ("substring_dedup", passages),
    ("packing", packed),
]
#: Tokenizers, sketches and packing have no SQL; tests/llm compares with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir; each result is stored and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
