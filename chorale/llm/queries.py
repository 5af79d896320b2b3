"""One query for each operator of this subpackage, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chorale.llm import (
    chat,
    decontaminate,
    fill_middle,
    html_text,
    kneser_ney,
    licenses,
    near_duplicates,
    packing,
    quality,
    sharding,
    source_divergence,
    substrings,
    toxicity,
)
from chorale.llm.oracle import ORACLE

__all__ = ["ORACLE", "QUERIES"]

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_shard_ring(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in 24 shards whose row counts differ by one at most."""
    keys = ["doc_id", "size", "text_crc32"]
    docs = sharding.measured(_table(spark, folder, "documents"))
    return sharding.assigned(docs, keys, sharding.Ring(24)).select(
        *keys,
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op2_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    """All conversations, and one that says control strings, rendered and read back."""
    said = "</s>[INST] ok [/INST]"
    rows = [(-7, 0, "user", said), (-7, 1, "assistant", said)]
    schema = "conv_id long, turn long, role string, text string"
    table = _table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    chats = table.unionByName(spark.createDataFrame(rows, schema))
    log = chat.replayed(chats)
    return chat.read_back(chat.formatted(chat.messages(log)))


def op3_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Line-first cleaning of all documents: word counts, base rules, what stays and verdict."""
    docs = quality.judged(_table(spark, folder, "documents"))
    return docs.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "n_lines",
        "n_failed_lines",
        "kept_chars",
    )


def op4_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    """Windows of all benchmark items in all documents."""
    return decontaminate.report(
        _table(spark, folder, "documents"), _table(spark, folder, "benchmark")
    )


def op5_kneser_ney(spark: SparkSession, folder: str) -> DataFrame:
    """Log probabilities of all documents by a model of those that aren't held out."""
    return kneser_ney.report(_table(spark, folder, "documents"))


def op6_html_text(spark: SparkSession, folder: str) -> DataFrame:
    """The main text of all pages."""
    return html_text.extracted(_table(spark, folder, "pages"))


def op7_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    """License phrases and templates in all documents."""
    return licenses.scanned(_table(spark, folder, "documents"))


def op8_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """The class of near copies that each document is in, named by its least id."""
    docs = near_duplicates.with_node(_table(spark, folder, "documents").select("doc_id", "text"))
    return near_duplicates.classes(docs).select("doc_id", "class_id", "kept")


def op9_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """All documents without the passages of 35 words or more that stand elsewhere too."""
    return substrings.report(_table(spark, folder, "documents"))


def op10_pack_best_fit(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in sequences of 2048 words without copies or more than two of a source."""
    return packing.packed(packing.measured(_table(spark, folder, "documents")))


def op11_fill_middle(spark: SparkSession, folder: str) -> DataFrame:
    """All documents cut at lines into prefix, middle and suffix, and put together again."""
    docs = fill_middle.transformed(_table(spark, folder, "documents"))
    return docs.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(fill_middle.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


def op12_source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    """Sources of a language by how far they are apart, and the terms that stand out in each."""
    return source_divergence.audited(_table(spark, folder, "documents"))


def op13_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of all documents, learned from labels of those that aren't held out."""
    return toxicity.report(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


QUERIES: dict[str, Query] = {
    "op1_shard_ring": op1_shard_ring,
    "op2_chat_format": op2_chat_format,
    "op3_quality_rules": op3_quality_rules,
    "op4_decontaminate": op4_decontaminate,
    "op5_kneser_ney": op5_kneser_ney,
    "op6_html_text": op6_html_text,
    "op7_license_scan": op7_license_scan,
    "op8_near_dedup": op8_near_dedup,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_pack_best_fit": op10_pack_best_fit,
    "op11_fill_middle": op11_fill_middle,
    "op12_source_divergence": op12_source_divergence,
    "op13_toxicity": op13_toxicity,
}
