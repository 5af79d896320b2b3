"""Implicit-feedback factor model: fitting, scoring and top-N lists."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chorale.columns import ITEM, ITEM_INDEX, PLAYS, POSITION, USER, USER_INDEX
from chorale.operators.features import apply_index, frequency_index
from chorale.session import ensure_checkpoint_dir, free_shuffles

# ALS cuts users and items into blocks and works on the product of both, so that many
# pairs lie in one block of that product. A task holds a row of the product.
PAIRS_PER_BLOCK = 10_000


@dataclass(frozen=True)
class FactorParams:
    """Hyper-parameters of one fit."""

    rank: int = 10
    reg: float = 0.05
    alpha: float = 0.1
    iterations: int = 20


@dataclass(frozen=True)
class Indexes:
    """Index tables of the train side. Without ``users`` the user ids are used as they are."""

    items: DataFrame
    users: DataFrame | None = None


def train_indexes(train: DataFrame, index_users: bool = True) -> Indexes:
    """Item index and user index by number of train pairs.

    The model takes ints. Without a user index, user ids must be ints themselves.
    """
    users = frequency_index(train, USER, USER_INDEX) if index_users else None
    return Indexes(frequency_index(train), users)


def index_pairs(ratings: DataFrame, indexes: Indexes) -> DataFrame:
    """(user, item, play count) with the model's numbers of both.

    Items and users that the train side lacks share one extra number each, which
    the model has never seen. A user id that is no int is an error unless users
    are indexed.
    """
    numbered = apply_index(ratings.select(USER, ITEM, PLAYS), indexes.items)
    if indexes.users is None:
        # An id out of range is an error in every session; a cast would wrap where ANSI mode is off.
        too_large = F.raise_error(F.concat(F.lit("user id is no int: "), F.col(USER).cast("string")))
        fits = F.col(USER).isNull() | F.col(USER).between(-(1 << 31), (1 << 31) - 1)
        own = F.when(fits, F.col(USER)).otherwise(too_large.cast("bigint"))
        return numbered.withColumn(USER_INDEX, own.cast("int"))
    return apply_index(numbered, indexes.users, USER, USER_INDEX)


def fit_factors(
    indexed: DataFrame, params: FactorParams, seed: int = 1, blocks: int | None = None
) -> ALSModel:
    """Fit non-negative implicit ALS; unknown users and items get no prediction.

    ALS cuts its lineage in the checkpoint folder at each iteration and deletes the shuffle
    files of those before, so disk does not grow with the iterations. Unless ``blocks`` is given, the
    pairs are counted first, and the number of blocks grows as the root of that count.
    """
    ensure_checkpoint_dir(indexed.sparkSession)
    free_shuffles(indexed.sparkSession)
    # Factors start from random numbers per block: the number must come from the data, or
    # another cluster would get another model.
    n_blocks = blocks or max(1, math.isqrt(indexed.count() // PAIRS_PER_BLOCK))
    als = ALS(
        rank=params.rank,
        maxIter=params.iterations,
        regParam=params.reg,
        alpha=params.alpha,
        seed=seed,
        userCol=USER_INDEX,
        itemCol=ITEM_INDEX,
        ratingCol=PLAYS,
        coldStartStrategy="drop",
        nonnegative=True,
        implicitPrefs=True,
        numUserBlocks=n_blocks,
        numItemBlocks=n_blocks,
        checkpointInterval=1,
    )
    return als.fit(indexed.select(USER_INDEX, ITEM_INDEX, PLAYS))


def predict(model: ALSModel, indexed: DataFrame) -> DataFrame:
    """The pairs whose user and item are known, with their ``prediction``."""
    return model.transform(indexed)


def predict_all(model: ALSModel, indexed: DataFrame) -> DataFrame:
    """All pairs; the ``prediction`` is null where the user or item is unknown."""
    scored = model.copy().setColdStartStrategy("nan").transform(indexed)
    prediction = F.col("prediction")
    return scored.withColumn("prediction", F.when(~F.isnan(prediction), prediction))


def step_residuals(model: ALSModel, indexed: DataFrame, params: FactorParams) -> DataFrame:
    """(user_index, residual): how far each user's factors are from the best ones for the items'.

    The last half of the last iteration solves, for each user, least squares under the bound
    that no factor is below zero: over all items with weight 1, and over the user's own with
    weights and targets from the plays. At the solution the slope is zero along factors above
    zero and not below zero along the others. ``residual`` is the largest slope that is not so,
    as a share of the largest pull of the user's items. ``indexed`` is what was fitted.
    """
    rank = model.rank
    items = model.itemFactors.select(
        F.col("id").alias(ITEM_INDEX), F.col("features").cast("array<double>").alias("y")
    )
    users = model.userFactors.select(
        F.col("id").alias(USER_INDEX), F.col("features").cast("array<double>").alias("x")
    )
    # Products of the items' factors, summed over all items: rank x rank numbers.
    row = items.select("y", F.posexplode("y").alias("j", "a"))
    cell = row.select("j", F.posexplode(F.transform("y", lambda v: v * F.col("a"))).alias("k", "p"))
    sums = {(r.j, r.k): r.p for r in cell.groupBy("j", "k").agg(F.sum("p").alias("p")).collect()}
    gram = F.array(*[F.array(*[F.lit(sums.get((j, k), 0.0)) for k in range(rank)]) for j in range(rank)])
    own = indexed.select(USER_INDEX, ITEM_INDEX, F.col(PLAYS).cast("double").alias("plays"))
    pairs = own.join(items, ITEM_INDEX).join(users, USER_INDEX)
    weight = F.lit(params.alpha) * F.abs("plays")
    target = F.when(F.col("plays") > 0, 1 + weight).otherwise(0.0)
    pairs = pairs.withColumn("target", target).withColumn("pull", weight * _product("x", "y") - F.col("target"))
    per_user = pairs.groupBy(USER_INDEX).agg(
        F.count(F.when(F.col("plays") > 0, 1)).alias("n_played"),
        F.array(*[F.sum(F.get("y", F.lit(j)) * F.col("pull")) for j in range(rank)]).alias("pulls"),
        F.array(*[F.sum(F.get("y", F.lit(j)) * F.col("target")) for j in range(rank)]).alias("targets"),
    )
    ridge = F.lit(params.reg) * F.col("n_played")
    slopes = F.transform(
        F.arrays_zip(gram.alias("of_all"), "pulls", "x"),
        lambda f: F.struct(
            (_product("x", f["of_all"]) + f["pulls"] + ridge * f["x"]).alias("slope"), f["x"].alias("x")
        ),
    )
    wrong = F.transform(slopes, lambda f: F.when(f["x"] > 0, F.abs(f["slope"])).otherwise(F.greatest(-f["slope"], F.lit(0.0))))
    largest = F.array_max(F.transform("targets", F.abs))
    return per_user.join(users, USER_INDEX).select(
        USER_INDEX, (F.array_max(wrong) / F.greatest(largest, F.lit(1e-12))).alias("residual")
    )


def _product(one: Column | str, other: Column | str) -> Column:
    products = F.zip_with(one, other, lambda a, b: a * b)
    return F.aggregate(products, F.lit(0.0), lambda total, value: total + value)


def recommend(model: ALSModel, indexed: DataFrame, top_n: int) -> DataFrame:
    """(user_index, recommendations): the best items of every known user in ``indexed``."""
    return model.recommendForUserSubset(indexed.select(USER_INDEX).distinct(), top_n)


def recommended_items(recommendations: DataFrame) -> DataFrame:
    """(user_index, predicted): item numbers in rank order."""
    items = F.transform("recommendations", lambda item: item[ITEM_INDEX])
    return recommendations.select(USER_INDEX, items.alias("predicted"))


def ranked_rows(recommendations: DataFrame) -> DataFrame:
    """(user_index, track_id_index, rating, pos): one row per recommendation."""
    return recommendations.select(
        USER_INDEX, F.posexplode("recommendations").alias("place", "item")
    ).select(USER_INDEX, "item.*", (F.col("place") + 1).alias(POSITION))


def named_rows(ranked: DataFrame, indexes: Indexes) -> DataFrame:
    """Recommendation rows with user ids and items instead of their numbers."""
    named = ranked.join(indexes.items, ITEM_INDEX)
    if indexes.users is None:
        named = named.withColumn(USER, F.col(USER_INDEX).cast("bigint"))
    else:
        named = named.join(indexes.users, USER_INDEX)
    return named.select(USER, ITEM, POSITION, "rating")
