"""The registered queries of these operators, over whole tables with production parameters."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rentscope.llm import (
    byte_bpe,
    exact_dedup,
    hard_negatives,
    language_id,
    near_dedup,
    packing,
    quality_classifier,
    quality_rules,
    sharding,
    substring_dedup,
    token_codes,
    warc,
    whitening,
)
from rentscope.llm.common import read_table

#: Folder with the files of the public tokenizers.
TOKENIZERS = os.environ.get("TOKENIZER_DIR", "/opt/tokenizers")
BYTE_BPE = "byte_bpe_50k.json"
BYTE_RANKS = "byte_bpe_multi_50k.tiktoken"
#: The pattern that splits text before the merges of the rank files (a fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
CODES_END, PACKING_END = 0, 2
SHARDS = 16
ANCHOR_EVERY = 100


def tokenizer(name: str) -> str:
    return os.path.join(TOKENIZERS, name)


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(spark, read_table(spark, sf_dir, "pages")).drop("uri")


def op2_token_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_codes.round_trip(
        spark, read_table(spark, sf_dir, "documents"), tokenizer(BYTE_BPE), CODES_END
    )


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.mark(read_table(spark, sf_dir, "documents"))


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.mark(read_table(spark, sf_dir, "documents"), size=near_dedup.MARK_SHINGLE)


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.encode(read_table(spark, sf_dir, "documents"), tokenizer(BYTE_RANKS), PATTERN)


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"), tokenizer(BYTE_BPE), PACKING_END)


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(read_table(spark, sf_dir, "documents"), [1.0] * SHARDS)


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.assess(read_table(spark, sf_dir, "documents"))


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.classify(
        read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    )


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.digests(read_table(spark, sf_dir, "documents"))


def op11_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(read_table(spark, sf_dir, "documents"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine(
        read_table(spark, sf_dir, "embeddings"),
        F.col("vec_id") % ANCHOR_EVERY == 0,
        hard_negatives.shifted_label(),
    )


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read_table(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_warc": op1_warc,
    "op2_token_codes": op2_token_codes,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_near_dedup": op4_near_dedup,
    "op5_byte_bpe": op5_byte_bpe,
    "op6_packing": op6_packing,
    "op7_sharding": op7_sharding,
    "op8_quality_rules": op8_quality_rules,
    "op9_quality_classifier": op9_quality_classifier,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_language_id": op11_language_id,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_whitening": op13_whitening,
}
