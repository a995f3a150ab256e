"""A training corpus from the documents table, in stages of which each works on what its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfwise.llm import jaccard, packing, pii, quality_rules, toxicity
from shelfwise.llm.common import written

#: Near copies share at least this percentage of their shingles of so many words.
SHINGLE_WORDS, SIMILAR_PERCENT = 5, 80


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.harmless(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.good(docs)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.one_of_each(docs, SHINGLE_WORDS, SIMILAR_PERCENT)


def mask_personal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.masked(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality rules", drop_poor),
    ("n-gram Jaccard join", drop_copies),
    ("PII", mask_personal),
    ("packing", pack),
]

#: Trained scores, set joins and BPE have no SQL form; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of the documents that the stages kept; each stage is written as a table and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
