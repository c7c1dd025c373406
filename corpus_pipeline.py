"""The corpus pipeline: quality rules, exact and near copies, source mix, tokens."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from heronlake.llm import bpe, exact_dedup, mixing, quality, simhash
from heronlake.llm.common import forget, written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the cutoffs found safe on the labels."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the smallest id."""
    return exact_dedup.drop_exact_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of fingerprints over three words that hang together at three or fewer bits, the smallest id."""
    return simhash.drop_near_copies(docs, shingle=3, bits=3)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target asks for."""
    return mixing.mix_documents(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, number of tokens, packed ids and digests of ids and decoded bytes."""
    import public_tokenizers

    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    return bpe.token_digest(bpe.round_trip(docs, path, pattern), "ids")


STAGES = [
    ("quality_rules", quality_rules),
    ("exact_dedup", exact_copies),
    ("simhash_dedup", near_copies),
    ("source_mix", source_mix),
    ("byte_bpe", token_ids),
]

# Byte-pair encoding is no SQL statement; tests hold the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again; what a later stage has read is deleted."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
        if before is not None:
            forget(before)
        before = docs
    return docs
