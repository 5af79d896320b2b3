"""Lists per user."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chorale.columns import ITEM, PLAYS, POSITION, USER
from chorale.operators.metrics import relevant_pairs
from chorale.operators.skew import POSITION as KEY_POSITION
from chorale.operators.skew import with_positions


def relevant_lists(df: DataFrame, list_rows: int = 100_000) -> DataFrame:
    """(user, part, actual): each user's items in order, ``list_rows`` to a part from 0.

    A list does not grow without bound; the parts joined in order are the list.
    """
    pairs = relevant_pairs(df)
    placed = with_positions(pairs, [USER], [ITEM], distinct=True)
    part = F.floor((F.col(KEY_POSITION) - 1) / list_rows).alias("part")
    lists = placed.groupBy(USER, part).agg(F.array_sort(F.collect_list(ITEM)).alias("actual"))
    return lists.select(USER, "part", "actual")


def top_n_per_user(ratings: DataFrame, top_n: int) -> DataFrame:
    """(user, item, play_count, pos): each user's most played items, equal counts by item.

    The bound on the row number is constant, so each task keeps only its own
    top rows of a user before the shuffle, however many the user has.
    """
    order = Window.partitionBy(USER).orderBy(F.desc(PLAYS), F.asc(ITEM))
    return (
        ratings.select(USER, ITEM, PLAYS)
        .withColumn(POSITION, F.row_number().over(order))
        .where(F.col(POSITION) <= top_n)
    )
