"""Damped popularity: one ranking of items that is the same for every user."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chorale.columns import ITEM, PLAYS, POSITION, TIME, USER
from chorale.operators.prepare import play_counts
from chorale.operators.skew import POSITION as PLACE
from chorale.operators.skew import day_of, with_global_positions

SCORE = "avg_listen_per_user"
# So many hashes at most in a sketch: 32 kB, and a standard error of 1.6 percent above.
SKETCH_SIZE = 4096


def popularity_scores(
    interactions: DataFrame,
    damping_factor: float = 100,
    user_threshold: int = 30,
    by: Sequence[str] = (),
) -> DataFrame:
    """(item, listen_count, user_count, avg_listen_per_user) of items with enough users.

    The score is listens / (users + damping). Takes events or counted pairs;
    events are counted to pairs first, which gives the number of users without
    a distinct aggregate.
    """
    has_counts = PLAYS in interactions.columns
    pairs = interactions if has_counts else play_counts(interactions)
    plays_of_known = F.when(F.col(USER).isNotNull(), F.col(PLAYS)).otherwise(F.lit(0))
    return (
        pairs.groupBy(*by, ITEM)
        .agg(F.sum(plays_of_known).alias("listen_count"), F.count(USER).alias("user_count"))
        .where(F.col("user_count") >= user_threshold)
        .withColumn(SCORE, F.col("listen_count") / (F.col("user_count") + F.lit(damping_factor)))
    )


def daily_state(events: DataFrame, size: int = SKETCH_SIZE) -> DataFrame:
    """(day, item, listens, users): what the scores need of each day's events.

    ``users`` is a sketch, the ``size`` least hashes of the day's users. States of other days are
    added with ``unionByName`` or written beside each other; none of the events they come from
    is needed again.
    """
    pairs = events.groupBy(day_of(events, TIME).alias("day"), ITEM, USER).agg(F.count(USER).alias("n"))
    listens = pairs.groupBy("day", ITEM).agg(F.sum("n").alias("listens"))
    hashes = pairs.where(F.col(USER).isNotNull()).select("day", ITEM, F.xxhash64(USER).alias("hash"))
    return _joined(listens, _least_hashes(hashes, ["day", ITEM], size), ["day", ITEM])


def scores_of_days(
    states: DataFrame,
    damping_factor: float = 100,
    user_threshold: int = 30,
    size: int = SKETCH_SIZE,
) -> DataFrame:
    """``popularity_scores`` from daily states, the same however they are cut into tables.

    Listens are exact, and so is the number of users below ``size``. From there on it is estimated
    from the largest of the least hashes, with a standard error of 1 / sqrt(size - 2) of it; so is
    the error of threshold and score.
    """
    listens = states.groupBy(ITEM).agg(F.sum("listens").alias("listen_count"))
    hashes = states.select(ITEM, F.explode("users").alias("hash")).distinct()
    merged = _joined(listens, _least_hashes(hashes, [ITEM], size), [ITEM])
    # Hashes are spread evenly from -2^63 to 2^63.
    largest = (F.element_at("users", -1).cast("double") + F.lit(2.0**63)) / F.lit(2.0**64)
    estimate = F.when(F.size("users") < size, F.size("users")).otherwise(F.round((size - 1) / largest))
    return (
        merged.select(ITEM, "listen_count", F.coalesce(estimate, F.lit(0)).cast("bigint").alias("user_count"))
        .where(F.col("user_count") >= user_threshold)
        .withColumn(SCORE, F.col("listen_count") / (F.col("user_count") + F.lit(damping_factor)))
    )


def _least_hashes(hashes: DataFrame, keys: list[str], size: int) -> DataFrame:
    """(keys, users): the least of the distinct hashes of each key, in order. The bound on the row
    number keeps each task's own before they are shuffled."""
    least = Window.partitionBy(*keys).orderBy("hash")
    held = hashes.withColumn("place", F.row_number().over(least)).where(F.col("place") <= size)
    return held.groupBy(*keys).agg(F.sort_array(F.collect_list("hash")).alias("users"))


def _joined(listens: DataFrame, users: DataFrame, keys: list[str]) -> DataFrame:
    """Both beside each other; a key may be null."""
    same = [F.col(f"l.{k}").eqNullSafe(F.col(f"u.{k}")) for k in keys]
    both = listens.alias("l").join(users.alias("u"), same, "left")
    return both.select("l.*", F.coalesce("u.users", F.array().cast("array<bigint>")).alias("users"))


def popularity_top(scores: DataFrame, top_n: int = 100) -> DataFrame:
    """The ``top_n`` best items with their ``pos`` from 1; equal scores go by item."""
    best_first = [F.desc(SCORE), F.asc(ITEM)]
    top = scores.orderBy(*best_first).limit(top_n)
    return top.withColumn(POSITION, F.row_number().over(Window.orderBy(*best_first)))


def popularity_ranking(scores: DataFrame) -> DataFrame:
    """(item, pos) for all scored items, in the order of ``popularity_top``."""
    keyed = scores.select(ITEM, (-F.col(SCORE)).alias("score_down"))
    return with_global_positions(keyed, ["score_down", ITEM]).select(
        ITEM, F.col(PLACE).alias(POSITION)
    )


def recommend_popular(users: DataFrame, top: DataFrame, top_n: int | None = None) -> DataFrame:
    """(user, predicted): every user with the same list of items, best first."""
    pairs = F.array_sort(F.collect_list(F.struct(POSITION, ITEM)))
    items = F.transform(pairs, lambda pair: pair[ITEM])
    if top_n is not None:
        items = F.slice(items, 1, top_n)
    return users.select(USER).withColumn("predicted", top.agg(items.alias("items")).scalar())
