"""The corpus pipeline: documents that pass the rules, one of each group of near-duplicates, without benchmark
passages, with pseudonyms, encoded.

Each stage takes all that the one before kept, which is written as Parquet to the shared folder in between. All but
the last return the columns of ``documents``; the last adds ``ids``, ``n_tokens`` and ``round_trip`` (whether the ids
decode to the text; these replace columns of the same names). Documents with a null id are judged like others but are
no near-duplicates; null texts fail the rules; empty tables pass through; further columns are kept.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from commitpost.llm import bpe, decontaminate, near_dup, pii, rules
from commitpost.plans.stage import stage
from workload.ship import ship

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return rules.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return near_dup.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pseudonyms(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.pseudonymise(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return bpe.encoded_and_checked(docs, RANKS, public_tokenizers.PATTERN)


STAGES = [
    ("quality rules", quality_rules),
    ("near-duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("pseudonyms", pseudonyms),
    ("encoding", encoding),
]

ORACLE_SQL = None
"""An isolation forest, sampled signatures and a keyed permutation are beyond SQL; tests compare with brute force."""


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, apply in STAGES:
        docs = stage(apply(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
