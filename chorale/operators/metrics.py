"""One metric pass for every model.

``relevant`` holds (user, item) pairs, ``ranking`` either (item, pos), the same
for all users, or (user, item, pos). Both stay rows: no user's list is ever
gathered as a whole, only the positions of hits in the first k places are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chorale.columns import ITEM, PLAYS, POSITION, USER
from chorale.functions import ranking_metrics as rm


def relevant_pairs(
    df: DataFrame, user: str = USER, item: str = ITEM, counted: bool = False
) -> DataFrame:
    """The set of (user, item) pairs in a table.

    A ``counted`` table has each pair once already, which saves the shuffle.
    """
    pairs = df.select(user, item)
    return pairs if counted else pairs.distinct()


def user_hits(
    relevant: DataFrame,
    ranking: DataFrame,
    k: int,
    whole_ranking: bool = False,
    user: str = USER,
    item: str = ITEM,
    extra: Sequence[Column] = (),
    users: DataFrame | None = None,
) -> DataFrame:
    """One row per user: ``n_relevant`` and the sorted ``hits`` within the first k places.

    With ``whole_ranking`` the items below place k count too and give
    ``n_ranked``, ``position_sum`` and ``first_position``. ``extra`` aggregates
    are taken over the relevant rows. ``users`` adds users without a relevant item.
    """
    personal = user in ranking.columns
    used = ranking if whole_ranking else ranking.where(F.col(POSITION) <= k)
    joined = relevant.join(used, [user, item] if personal else [item], "left")
    place = F.col(POSITION)
    found = [
        F.count(F.lit(1)).alias("n_relevant"),
        F.array_sort(F.collect_list(F.when(place <= k, place))).alias("hits"),
    ]
    if whole_ranking:
        found += [
            F.count(place).alias("n_ranked"),
            F.sum(place).alias("position_sum"),
            F.min(place).alias("first_position"),
        ]
    per_user = joined.groupBy(user).agg(*found, *extra)
    if users is None:
        return per_user
    return (
        users.select(user)
        .distinct()
        .join(per_user, user, "left")
        .withColumn("n_relevant", F.coalesce("n_relevant", F.lit(0)))
        .withColumn("hits", F.coalesce("hits", F.array().cast("array<int>")))
    )


def mean_metrics(
    per_user: DataFrame,
    ks: Sequence[int],
    n_items: Column | None = None,
    keep: Sequence[str] = (),
    extra: Sequence[Column] = (),
    by: Sequence[str] = (),
) -> DataFrame:
    """One row per k: k, n_users, map, precision, ndcg and recall, averaged over users.

    With ``n_items``, the length of the whole ranking, also auc and mrr over the
    users for which they are defined. ``extra`` aggregates are taken over the
    users' columns ``keep`` in the same pass. With columns ``by``, one row for each of their
    values and k.
    """
    names = ["map", "precision", "ndcg", "recall"]
    per_k = F.expr(f"array({', '.join(rm.metrics_at(k) for k in ks)})")
    kept = [F.col(name) for name in keep]
    if n_items is not None:
        per_user = per_user.withColumn("n_items", n_items)
        kept += [F.expr(rm.auc()).alias("auc"), F.expr(rm.reciprocal_rank()).alias("mrr")]
        names += ["auc", "mrr"]
    rows = per_user.select(F.explode(per_k).alias("at"), *by, *kept).select(
        "at.*", *by, *keep, *names[4:]
    )
    means = [F.avg(name).alias(name) for name in names]
    return rows.groupBy(*by, "k").agg(F.count(F.lit(1)).alias("n_users"), *means, *extra)


def ranking_metrics(
    relevant: DataFrame,
    ranking: DataFrame,
    ks: Sequence[int],
    user: str = USER,
    item: str = ITEM,
    users: DataFrame | None = None,
) -> DataFrame:
    """MAP, precision, NDCG and recall at each k for a top-N ranking."""
    per_user = user_hits(relevant, ranking, max(ks), user=user, item=item, users=users)
    return mean_metrics(per_user, ks)


def full_ranking_metrics(relevant: DataFrame, ranking: DataFrame, ks: Sequence[int]) -> DataFrame:
    """The same with AUC and mean reciprocal rank, for a whole ranking shared by all users."""
    n_items = ranking.agg(F.max(POSITION).alias("n_items")).scalar()
    per_user = user_hits(relevant, ranking, max(ks), whole_ranking=True)
    return mean_metrics(per_user, ks, n_items)


def rmse(predictions: DataFrame, label: str = PLAYS, prediction: str = "prediction") -> DataFrame:
    """One row: number of predictions and their root mean square error."""
    error = F.col(label).cast("double") - F.col(prediction).cast("double")
    return predictions.agg(
        F.count(F.lit(1)).alias("n_pairs"), F.sqrt(F.avg(error * error)).alias("rmse")
    )
