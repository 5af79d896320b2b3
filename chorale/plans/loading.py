"""Events to counted train, validation and test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from chorale.columns import IS_TRAIN
from chorale.operators.prepare import clean_interactions, play_counts, sample_rows
from chorale.operators.splits import prepare_test, tag_by_user_time
from chorale.sources.tables import (
    Dataset,
    build_once,
    load_ratings,
    load_split,
    manifest,
    materialize,
    read_interactions,
    write_files,
    write_split,
)


def split_ratings(interactions: DataFrame, ratio: float = 0.8) -> DataFrame:
    """(is_train, user, item, play_count): each side counted on its own, in one pass."""
    tagged = tag_by_user_time(clean_interactions(interactions), ratio)
    return play_counts(tagged, IS_TRAIN)


def prepare(
    spark: SparkSession, data: Dataset, ratio: float = 0.8, with_test: bool | None = None
) -> dict[str, DataFrame]:
    """The counted tables ``train``, ``validation`` and ``test``.

    What is written already from the same input files and with the same ratio is read; the rest
    is built, written and read. Unless told otherwise by ``with_test``, there is a test table for
    full data only.
    """
    split, events = data.split(ratio), data.input("interactions")
    build_once(
        spark,
        split,
        manifest(spark, [events], ratio=ratio),
        lambda: write_split(split_ratings(read_interactions(spark, events), ratio), split),
    )
    tables = {side: load_split(spark, split, side) for side in ("train", "validation")}
    if data.has_test if with_test is None else with_test:
        held_out = data.input("interactions", "test")
        materialize(
            spark,
            data.test,
            lambda: prepare_test(read_interactions(spark, held_out)),
            manifest(spark, [held_out]),
        )
        tables["test"] = load_ratings(spark, data.test)
    return tables


def write_samples(
    tables: dict[str, DataFrame], data: Dataset, fraction: float = 0.01, seed: int = 1
) -> None:
    """A row sample of the train and of the validation table, each in one file."""
    for side in ("train", "validation"):
        write_files(sample_rows(tables[side], fraction, seed), data.sample(side))
