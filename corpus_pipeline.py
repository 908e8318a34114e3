"""Corpus pipeline: quality rules, near duplicates, benchmark decontamination, personal data, mixing.

Each stage works on all documents that the one before it kept. The first four return the columns of documents: rejected
documents and all but one of near duplicates go, documents with a benchmark window go, personal data is replaced by its
kind. The last returns the mix: a document once for each copy that the mix takes, with its copy number.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from remitlens.llm import decontaminate, mixing, ngram_join, personal_data, quality_rules
from remitlens.storage import stored


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.passing(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.unique(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def masking(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return personal_data.masked(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.emitted(docs)


STAGES = [
    ("quality rules", quality),
    ("near duplicates", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("personal data", masking),
    ("mixing", mix),
]
#: Components of near duplicates and bootstrapped patterns need loops; the tests hold run() against plain Python instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
