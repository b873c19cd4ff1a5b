"""The corpus pipeline: language identification, near-duplicates, benchmark
decontamination, secrets, packing. Each stage works on all that the one
before it kept; its result is written as Parquet and read again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from strainmeter.llm import bagminhash, decontaminate, language, packing, secretscan
from strainmeter.llm.tables import table, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a known language."""
    return language.identified(docs)


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near-duplicates."""
    return bagminhash.deduplicated(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a passage of ``benchmark``."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def scrub(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces secrets in the texts; no document goes."""
    return secretscan.redacted(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 2048 ids."""
    return packing.packed(docs, with_ids=False)


STAGES: list[tuple[str, Stage]] = [
    ("language", identify),
    ("near_duplicates", deduplicate),
    ("decontamination", decontaminated),
    ("secrets", scrub),
    ("packing", pack),
]

#: SQL can express none of the stages; tests hold run() against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over the whole ``documents`` table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
