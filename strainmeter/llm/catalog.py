"""Registered queries of this subpackage, over whole tables with the
operators' production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from strainmeter.llm import bagminhash, centroids, decontaminate, language, packing, passages, pii, quality, secretscan, shards, spellings, toxicity, vectors
from strainmeter.llm.tables import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_secretscan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secretscan.scanned(table(spark, sf_dir, "documents"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.repeated(table(spark, sf_dir, "documents"))


def op4_bagminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bagminhash.near_duplicates(table(spark, sf_dir, "documents"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.found(table(spark, sf_dir, "documents"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.rated(table(spark, sf_dir, "documents"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.digest(table(spark, sf_dir, "documents"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"), with_ids=False)


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.languages(table(spark, sf_dir, "documents"))


def op10_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_duplicates(table(spark, sf_dir, "embeddings"))


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.clustered(table(spark, sf_dir, "embeddings"))


def op13_spellings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spellings.variants(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (op1_secretscan, op2_decontamination, op3_passages, op4_bagminhash, op5_pii, op6_quality, op7_sharding, op8_packing, op9_language, op10_vectors, op11_toxicity, op12_centroids, op13_spellings)
}

#: DuckDB SQL of the queries that SQL can express.
SQL: dict[str, str] = {"op12_centroids": centroids.SQL}
