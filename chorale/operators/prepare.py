"""Cleaning, counting, thresholds, profiles and samples of interaction tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chorale.columns import ITEM, PLAYS, USER
from chorale.functions.hashing import unit_hash
from chorale.operators.skew import with_key_rows


def clean_interactions(df: DataFrame, drop: tuple[str, ...] = ("recording_mbid",)) -> DataFrame:
    """Without the columns ``drop`` (where present) and without rows that hold a null."""
    return df.drop(*drop).na.drop("any")


def user_totals(df: DataFrame) -> DataFrame:
    """Rows per user."""
    return df.groupBy(USER).agg(F.count(F.lit(1)).alias("total_rows"))


def play_counts(df: DataFrame, *also_by: str) -> DataFrame:
    """One row per (user, item) with its number of events.

    The count stays a bigint: one pair may have more plays than an int holds.
    """
    return df.groupBy(*also_by, USER, ITEM).agg(F.count(F.lit(1)).alias(PLAYS))


def with_play_count(df: DataFrame) -> DataFrame:
    """Every event with the play count of its (user, item) pair."""
    return with_key_rows(df, [USER, ITEM], PLAYS).na.fill(0, subset=[PLAYS])


def min_plays(ratings: DataFrame, plays: int, inclusive: bool = True) -> DataFrame:
    """Pairs with at least ``plays`` plays, or with more than that if not ``inclusive``."""
    count = F.col(PLAYS)
    return ratings.where(count >= plays if inclusive else count > plays)


def dedupe_ratings(df: DataFrame) -> DataFrame:
    """One row per (user, item, play count); needed for tables counted at event grain only."""
    return df.select(USER, ITEM, PLAYS).dropDuplicates([USER, ITEM, PLAYS])


def distinct_users(df: DataFrame) -> DataFrame:
    return df.select(USER).distinct()


def distinct_items(df: DataFrame) -> DataFrame:
    return df.select(ITEM).distinct()


def profile(ratings: DataFrame) -> DataFrame:
    """One row: number of rows, users and items, and the greatest play count.

    Users and items are counted from a grouping each; two distinct counts in one
    aggregation would write every pair out twice.
    """
    by_user = ratings.groupBy(USER).agg(
        F.count(F.lit(1)).alias("n"), F.max(PLAYS).alias("max_play_count")
    )
    n_items = ratings.select(ITEM).distinct().agg(F.count(ITEM).alias("n")).scalar()
    return by_user.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
        F.count(USER).alias("n_users"),
        n_items.alias("n_items"),
        F.max("max_play_count").alias("max_play_count"),
    )


def heaviest_pairs(ratings: DataFrame) -> DataFrame:
    """All pairs whose play count is the greatest one."""
    return ratings.where(F.col(PLAYS) == ratings.agg(F.max(PLAYS)).scalar())


def union_all(first: DataFrame, second: DataFrame) -> DataFrame:
    """Rows of both tables, matched by column name."""
    return first.unionByName(second)


def sample_rows(df: DataFrame, fraction: float, seed: int = 1) -> DataFrame:
    """Bernoulli sample without replacement."""
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def sample_by_hash(df: DataFrame, fraction: float, columns: list[str], seed: int = 1) -> DataFrame:
    """Bernoulli sample that is decided by the values of ``columns`` alone."""
    return df.where(unit_hash(columns, seed) < fraction)
