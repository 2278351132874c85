"""The corpus pipeline: five stages from raw documents to packed sequences."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import materialise
from quarry.llm.exact_dedup import drop_exact_copies
from quarry.llm.mixing import mix
from quarry.llm.near_dedup import drop_near_copies
from quarry.llm.packing import pack_documents
from quarry.llm.quality import keep_good


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return drop_exact_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near-duplicates: five-word shingles, similarity 0.8 or more."""
    return drop_near_copies(docs, words=5, percent=80)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, interleaved to the sources' target weights."""
    return mix(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 1024 token ids."""
    out = pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=0)
    return out.select(F.col("id").alias("doc_id"), "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [("quality", quality), ("exact_dedup", exact), ("near_dedup", near), ("mixing", mixing), ("packing", packing)]

#: A trained classifier and a tokenizer have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over all documents, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
