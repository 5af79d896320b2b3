"""The popularity model and its metrics on several evaluation sets."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chorale.operators.metrics import ranking_metrics, relevant_pairs
from chorale.operators.popularity import popularity_scores, popularity_top


def run_popularity(
    train: DataFrame,
    evaluation_sets: dict[str, DataFrame],
    ks: Sequence[int] = (100,),
    damping_factor: float = 200,
    user_threshold: int = 30,
    counted: bool = False,
) -> DataFrame:
    """MAP, precision, NDCG and recall of the most popular items, one row per set and k.

    ``counted`` says that the evaluation sets hold each (user, item) pair once.
    """
    scores = popularity_scores(train, damping_factor, user_threshold)
    top = popularity_top(scores, max(ks))
    rows = [
        ranking_metrics(relevant_pairs(table, counted=counted), top, ks).withColumn(
            "evaluated_on", F.lit(name)
        )
        for name, table in evaluation_sets.items()
    ]
    return reduce(DataFrame.unionByName, rows)
