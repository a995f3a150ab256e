"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import bpe, chat, divergence, embeddings, jaccard, katz, packing, periodic, pii, quality_classifier, quality_rules, toxicity, wavelet

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz.scores(table(spark, sf_dir, "documents"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"))


def op4_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.classes(table(spark, sf_dir, "documents"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.detect(table(spark, sf_dir, "documents"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality(table(spark, sf_dir, "documents"))


def op7_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.scored(table(spark, sf_dir, "documents"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op9_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


def op10_wavelet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wavelet.read(wavelet.write(table(spark, sf_dir, "documents")))


def op11_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.periodic(table(spark, sf_dir, "documents"), prepare=periodic.planted)


def op12_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = chat.with_marks(spark, table(spark, sf_dir, "conversations"))
    return chat.read_back(chat.formatted(chat.turns(chat.turn_records(rows))))


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Query]:
    return {name: f for name, f in globals().items() if name.startswith("op") and callable(f)}


def oracle_sql() -> dict[str, str]:
    return {"op13_divergence": divergence.SQL}
