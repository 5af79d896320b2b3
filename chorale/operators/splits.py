"""Train and validation splits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chorale.columns import EVENT, IS_TRAIN, ITEM, TIME, USER
from chorale.functions.hashing import unit_hash
from chorale.operators.prepare import clean_interactions, play_counts
from chorale.operators.skew import KEY_ROWS, POSITION, with_positions


def tag_by_user_time(df: DataFrame, ratio: float = 0.8) -> DataFrame:
    """Every event with ``is_train``: true for the earliest ``ratio`` of its user's events.

    The number of train events of a user is rounded down, so a user with one
    event has it in validation. Equal times are ordered by item and then by the
    remaining columns. Events without a user belong to neither side. Tables with event
    ids hold no row twice.
    """
    known = df.where(F.col(USER).isNotNull())
    placed = with_positions(known, [USER], [TIME, ITEM], EVENT in df.columns)
    threshold = F.floor(F.col(KEY_ROWS) * F.lit(ratio)).cast("bigint")
    return placed.withColumn(IS_TRAIN, F.col(POSITION) <= threshold).drop(POSITION, KEY_ROWS)


def train_side(tagged: DataFrame) -> DataFrame:
    return tagged.where(F.col(IS_TRAIN)).drop(IS_TRAIN)


def validation_side(tagged: DataFrame) -> DataFrame:
    return tagged.where(~F.col(IS_TRAIN)).drop(IS_TRAIN)


def split_by_user_time(df: DataFrame, ratio: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """(train, validation) events. Where both sides are needed more than once, write
    the tagged table instead (``chorale.plans.loading``), so that it is sorted once."""
    tagged = tag_by_user_time(df, ratio)
    return train_side(tagged), validation_side(tagged)


def tag_random_pairs(ratings: DataFrame, test_fraction: float = 0.2, seed: int = 1) -> DataFrame:
    """Every pair with ``is_train``, drawn by a hash of user, item and seed."""
    return ratings.withColumn(IS_TRAIN, unit_hash([USER, ITEM], seed) >= test_fraction)


def split_random_pairs(
    ratings: DataFrame, test_fraction: float = 0.2, seed: int = 1
) -> tuple[DataFrame, DataFrame]:
    """(train, test) pairs, drawn at random but the same on every run."""
    tagged = tag_random_pairs(ratings, test_fraction, seed)
    return train_side(tagged), validation_side(tagged)


def split_random_rows(
    df: DataFrame, ratio: float = 0.8, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """(train, validation) rows by ``randomSplit``."""
    train, validation = df.randomSplit([ratio, 1.0 - ratio], seed=seed)
    return train, validation


def prepare_test(df: DataFrame) -> DataFrame:
    """Play counts of a held-out interaction table."""
    return play_counts(clean_interactions(df))
