"""A corpus from raw documents to packed sequences, stage by stage.

Every stage takes ``(spark, docs, sf_dir)`` and gives a DataFrame, which is written as
Parquet and read again as the next one's ``docs``. All but the last keep the columns of
``documents``; ``n_chars`` follows the text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chorale.llm import decontaminate, near_duplicates, packing, quality, substrings
from chorale.session import scratch_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What failed of the lines goes, and with it the documents that consist of little else."""
    return quality.cleaned(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near copies one document stays, the one with the least id."""
    return near_duplicates.deduplicated(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that stand twice are cut; a document that was nothing else goes."""
    # Own names for what is found, so that no column of the documents is replaced.
    aside = {c: f"__{c}" for c in ("n_words", "n_removed")}
    left = substrings.deduplicated(docs.withColumnsRenamed(aside))
    left = left.where("n_removed = 0 OR n_removed < n_words").drop(*aside)
    left = left.withColumnsRenamed({v: k for k, v in aside.items()})
    return left.withColumn("n_chars", F.length("text").cast("bigint")).select(docs.columns)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.without_contaminated(docs, items)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document stands in which sequence."""
    return packing.packed(packing.measured(docs))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("best_fit_packing", best_fit_packing),
]

#: Signatures, components and best fit are not for SQL; tests hold them against plain Python.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each reads what the one before wrote."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
