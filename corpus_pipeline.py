"""The training-corpus pipeline: what of ``documents`` reaches the model.

Stages, each written as Parquet and read again as the next one's documents:
toxic documents go, one document of each group of near duplicates stays,
personal data is pseudonymised, sources are mixed to their target weights, and
the texts are encoded (with the digest of the decoded round trip).
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from verity.llm.bpe import round_trip
from verity.llm.common import Staging
from verity.llm.minhash import drop_near_duplicates
from verity.llm.mixing import mix
from verity.llm.pii import pseudonymise
from verity.llm.queries import documents, tokenizer_path
from verity.llm.toxicity import drop_toxic


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near_duplicates(docs)


def with_pseudonyms(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pseudonymise(docs).select(*docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return round_trip(docs, tokenizer_path(), keep_ids=True)


STAGES = [
    ("toxicity", without_toxic),
    ("near_dedup", without_near_duplicates),
    ("pseudonyms", with_pseudonyms),
    ("source_mix", mixed),
    ("bpe", encoded),
]

# Neighbour votes over a fitted index are not expressible in SQL; tests/llm
# compares every stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    staging = Staging(spark, "pipeline")
    docs = documents(spark, sf_dir)
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = staging.write(docs, name)
            if i:
                staging.drop(STAGES[i - 1][0])
    return docs
