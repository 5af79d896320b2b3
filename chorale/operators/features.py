"""Dense integer indexes for items and users, held as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chorale.columns import ITEM, ITEM_INDEX, PLAYS, TIME, USER
from chorale.operators.skew import POSITION, with_global_positions


def frequency_index(df: DataFrame, column: str = ITEM, name: str = ITEM_INDEX) -> DataFrame:
    """(column, name): values numbered from 0 by number of rows descending, then by value."""
    counted = (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg((-F.count(F.lit(1))).alias("rows_down"))
    )
    return _numbered(counted, ["rows_down", column], column, name)


def first_seen_index(
    df: DataFrame, seen_by: str = TIME, column: str = ITEM, name: str = ITEM_INDEX
) -> DataFrame:
    """(column, name): values numbered from 0 by their least ``seen_by``, then by value.

    For a table of counted pairs, which has no time, ``seen_by`` is the user:
    that is the order in which items appear in rows sorted by user and item.
    """
    counted = (
        df.where(F.col(column).isNotNull()).groupBy(column).agg(F.min(seen_by).alias("first_seen"))
    )
    return _numbered(counted, ["first_seen", column], column, name)


def apply_index(
    df: DataFrame,
    index: DataFrame,
    column: str = ITEM,
    name: str = ITEM_INDEX,
    unseen: str = "keep",
) -> DataFrame:
    """``df`` with the index number of ``column`` as an int.

    Values outside the index, and nulls, get one extra number after the last
    (``keep``), or their rows are left out (``drop``).
    """
    if unseen == "drop":
        return df.join(index, column, "inner")
    if unseen != "keep":
        raise ValueError(f"unseen must be 'keep' or 'drop', not {unseen!r}")
    extra = index.agg(F.count(F.lit(1)).cast("int").alias("extra")).scalar()
    return df.join(index, column, "left").withColumn(name, F.coalesce(F.col(name), extra))


def indexed_ratings(ratings: DataFrame, index: DataFrame, unseen: str = "keep") -> DataFrame:
    """(user, item, item index, play count): a sparse matrix in coordinate form."""
    return apply_index(ratings, index, unseen=unseen).select(USER, ITEM, ITEM_INDEX, PLAYS)


def _numbered(counted: DataFrame, order: list[str], column: str, name: str) -> DataFrame:
    placed = with_global_positions(counted, order)
    return placed.select(column, (F.col(POSITION) - 1).cast("int").alias(name))
