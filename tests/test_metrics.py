import math
import random

import pytest
from pyspark.ml.evaluation import RankingEvaluator, RegressionEvaluator
from pyspark.mllib.evaluation import RankingMetrics
from pyspark.sql import functions as F

from chorale.operators.metrics import full_ranking_metrics, ranking_metrics, rmse

RELEVANT = "user_id bigint, recording_msid string"
PERSONAL = "user_id bigint, recording_msid string, pos int"
SHARED = "recording_msid string, pos int"

NAMES = {
    "map": "meanAveragePrecisionAtK",
    "precision": "precisionAtK",
    "ndcg": "ndcgAtK",
    "recall": "recallAtK",
}


def by_evaluator(spark, lists, k):
    """lists: (predicted, actual) per user, items as numbers."""
    rows = [([float(p) for p in ps], [float(a) for a in actual]) for ps, actual in lists]
    df = spark.createDataFrame(rows, "prediction array<double>, label array<double>")
    return {
        ours: RankingEvaluator(metricName=theirs, k=k).evaluate(df) for ours, theirs in NAMES.items()
    }


def ours(spark, lists, k):
    relevant = [(u, str(a)) for u, (_, actual) in enumerate(lists) for a in actual]
    ranked = [
        (u, str(p), n) for u, (ps, _) in enumerate(lists) for n, p in enumerate(ps, start=1)
    ]
    users = spark.createDataFrame([(u,) for u in range(len(lists))], "user_id bigint")
    row = ranking_metrics(
        spark.createDataFrame(relevant, RELEVANT).distinct(),
        spark.createDataFrame(ranked, PERSONAL),
        [k],
        users=users,
    ).first()
    return row.asDict()


CASES = {
    "short_list": [([1, 2], [1, 9])],
    "empty_relevant": [([1, 2, 3], []), ([1, 2], [2])],
    "empty_predicted": [([], [1, 2]), ([1], [1])],
    "dup_relevant": [([1, 2, 3], [2, 2, 3])],
    "more_relevant_than_k": [([1, 2, 3, 4, 5, 6, 7], [1, 2, 3, 4, 5, 6, 7, 8])],
}


@pytest.mark.parametrize("name", CASES)
def test_edges_equal_the_built_in_evaluator(spark, name):
    got, expected = ours(spark, CASES[name], 5), by_evaluator(spark, CASES[name], 5)
    for metric in NAMES:
        assert got[metric] == pytest.approx(expected[metric], abs=1e-12), metric
    assert got["n_users"] == len(CASES[name])


@pytest.mark.parametrize("k", [3, 10])
def test_random_lists_equal_both_built_ins(spark, k):
    draw = random.Random(k)
    items = list(range(30))
    lists = [(draw.sample(items, 12), draw.sample(items, draw.randrange(1, 9))) for _ in range(40)]
    got, expected = ours(spark, lists, k), by_evaluator(spark, lists, k)
    for metric in NAMES:
        assert got[metric] == pytest.approx(expected[metric], abs=1e-12), metric
    older = RankingMetrics(spark.sparkContext.parallelize(lists))
    assert got["map"] == pytest.approx(older.meanAveragePrecisionAt(k), abs=1e-12)
    assert got["precision"] == pytest.approx(older.precisionAt(k), abs=1e-12)
    assert got["ndcg"] == pytest.approx(older.ndcgAt(k), abs=1e-12)


def test_full_ranking_equals_counting_pairs(spark):
    draw = random.Random(1)
    ranking = [f"i{n}" for n in range(25)]
    relevant = {u: draw.sample([*ranking, "unranked"], draw.randrange(1, 10)) for u in range(20)}
    relevant[90], relevant[91] = list(ranking), ["unranked"]
    rows = [(u, i) for u, chosen in relevant.items() for i in chosen]
    got = full_ranking_metrics(
        spark.createDataFrame(rows, RELEVANT),
        spark.createDataFrame([(i, n) for n, i in enumerate(ranking, 1)], SHARED),
        [5],
    ).first()
    areas, firsts = [], []
    for chosen in relevant.values():
        inside = [i for i in ranking if i in chosen]
        others = [i for i in ranking if i not in chosen]
        if inside:
            firsts.append(1 / (ranking.index(inside[0]) + 1))
        if inside and others:
            right = sum(ranking.index(a) < ranking.index(b) for a in inside for b in others)
            areas.append(right / (len(inside) * len(others)))
    assert got.auc == pytest.approx(sum(areas) / len(areas), abs=1e-12)
    assert got.mrr == pytest.approx(sum(firsts) / len(firsts), abs=1e-12)
    assert got.n_users == len(relevant)


def test_auc_is_null_without_an_unrelevant_item(spark):
    got = full_ranking_metrics(
        spark.createDataFrame([(1, "a"), (1, "b")], RELEVANT),
        spark.createDataFrame([("a", 1), ("b", 2)], SHARED),
        [5],
    ).first()
    assert got.auc is None and got.mrr == 1.0


def test_rmse_equals_the_built_in(spark):
    df = spark.createDataFrame([(3, 1.5), (2, 2.0), (7, 4.25)], "play_count int, prediction float")
    got = rmse(df).first()
    built_in = RegressionEvaluator(metricName="rmse", labelCol="play_count", predictionCol="prediction")
    assert got.rmse == pytest.approx(built_in.evaluate(df.withColumn("play_count", F.col("play_count").cast("double"))))
    assert got.n_pairs == 3 and math.isfinite(got.rmse)
