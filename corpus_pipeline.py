"""The corpus pipeline: five stages over ``documents``, each written as Parquet and read again by the next.

quality rules -> one of each group of near copies -> benchmark decontamination -> pseudonyms -> packed sequences
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from leadloom.llm.decontam import clean_documents
from leadloom.llm.ngram_join import one_of_each_group
from leadloom.llm.packing import pack
from leadloom.llm.pii import replace_pii
from leadloom.llm.quality import quality
from leadloom.session import shared_dir

PII_KEY = "corpus-pipeline"  # a deployment passes its own secret to replace_pii


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    return quality(docs).where("kept").select(*docs.columns)


def one_per_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, similarity 0.8)."""
    return one_of_each_group(docs, words=5, percent=80)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with pseudonyms for personal data; ``n_chars`` keeps describing the source."""
    return replace_pii(docs, PII_KEY)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all sequences."""
    return pack(docs)


STAGES = [("quality", good_documents), ("near_duplicates", one_per_group), ("decontamination", without_benchmark),
          ("pii", without_personal_data), ("packing", packed)]

ORACLE_SQL = None  # token ids have no SQL form; tests/llm compares every stage with a plain Python version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{shared_dir(spark).rstrip('/')}/pipeline/{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
