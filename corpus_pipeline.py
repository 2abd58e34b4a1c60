"""A training-data pipeline over ``documents``: quality rules, near duplicates,
secrets, source mixture, packing.

Each stage takes what its predecessor kept and returns the columns of documents;
the last returns the pieces of packed sequences. Between stages the rows are
written as Parquet in the shared folder and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rxlake.llm import jaccard, mixing, packing, quality, secret_scan
from rxlake.llm.queries import byte_bpe
from rxlake.llm.store import keep


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: documents that the quality rules keep."""
    rules = quality.QualityRules.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.keep_good(docs, rules)


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: of each group of near duplicates the document of smallest id."""
    return jaccard.one_of_each(docs)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: found secrets replaced by a mark."""
    return secret_scan.redact(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: each document as often as the source mixture takes it."""
    return mixing.mix(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: pieces of fixed-length sequences."""
    return packing.pack(docs, byte_bpe(), ["doc_id"], with_ids=False)


STAGES = [
    ("quality_rules", good_documents),
    ("near_duplicates", distinct_documents),
    ("secret_scan", without_secrets),
    ("source_mixture", mixture),
    ("packing", packed),
]

#: The trees and the tokenizer have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = keep(docs, name)
    return docs
