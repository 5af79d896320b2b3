import gc
import random
import time

import numpy as np
import pytest
from pyspark.ml.evaluation import RankingEvaluator, RegressionEvaluator
from pyspark.sql import functions as F

from chorale.operators import factors as fa
from chorale.operators import nearest
from chorale.operators import factor_ranks
from chorale.operators.factor_ranks import full_rank_sums
from chorale.plans import catalogue, comparison, factors

RATINGS = "user_id bigint, recording_msid string, play_count bigint"
PARAMS = fa.FactorParams(rank=3, reg=0.05, alpha=1.0, iterations=4)


@pytest.fixture(scope="module")
def ratings(spark):
    draw = random.Random(2)
    rows = {(u, f"i{draw.randrange(25):02d}"): draw.randrange(1, 9) for u in range(30) for _ in range(8)}
    return spark.createDataFrame([(*pair, n) for pair, n in rows.items()], RATINGS).cache()


@pytest.fixture(scope="module")
def validation(spark):
    draw = random.Random(3)
    rows = {(u, f"i{draw.randrange(30):02d}"): draw.randrange(1, 5) for u in range(35) for _ in range(5)}
    return spark.createDataFrame([(*pair, n) for pair, n in rows.items()], RATINGS).cache()


@pytest.fixture(scope="module")
def fitted(ratings):
    indexes = fa.train_indexes(ratings)
    return fa.fit_factors(fa.index_pairs(ratings, indexes), PARAMS, blocks=2), indexes


def test_cold_start_rows_get_no_prediction(ratings, validation, fitted):
    model, indexes = fitted
    users = {r.user_id for r in ratings.collect()}
    items = {r.recording_msid for r in ratings.collect()}
    known = {
        (r.user_id, r.recording_msid)
        for r in validation.collect()
        if r.user_id in users and r.recording_msid in items
    }
    scored = fa.predict(model, fa.index_pairs(validation, indexes)).collect()
    assert {(r.user_id, r.recording_msid) for r in scored} == known
    assert 0 < len(known) < validation.count()
    assert all(r.prediction >= 0 for r in scored)


def test_recommendations_are_in_rank_order(validation, fitted):
    model, indexes = fitted
    found = fa.recommend(model, fa.index_pairs(validation, indexes), 5)
    lists = {r.user_index: r.predicted for r in fa.recommended_items(found).collect()}
    assert set(lists) == set(range(30))  # unknown users are missing
    for row in found.collect():
        ratings = [item.rating for item in row.recommendations]
        assert ratings == sorted(ratings, reverse=True) and len(ratings) == 5
        assert lists[row.user_index] == [item.track_id_index for item in row.recommendations]
    (user,) = indexes.users.where("user_index = 4").collect()
    named = fa.named_rows(fa.ranked_rows(found), indexes).where(f"user_id = {user.user_id}")
    named = named.orderBy("pos").collect()
    numbers = {r.recording_msid: r.track_id_index for r in indexes.items.collect()}
    assert [numbers[r.recording_msid] for r in named] == lists[4]


def test_same_seed_gives_the_same_lists(ratings, fitted):
    model, indexes = fitted
    indexed = fa.index_pairs(ratings, indexes)
    again = fa.fit_factors(indexed, PARAMS, blocks=2)
    top = [
        {r.user_index: r.predicted for r in fa.recommended_items(fa.recommend(m, indexed, 5)).collect()}
        for m in (model, again)
    ]
    assert top[0] == top[1]


def test_the_model_depends_on_the_pairs_alone(ratings):
    """Not on how many tasks hand them in, which is what another number of cores changes."""
    indexed = fa.index_pairs(ratings, fa.train_indexes(ratings))
    lists = []
    for parts in (2, 13):
        model = fa.fit_factors(indexed.repartition(parts, "user_index"), PARAMS)
        top = fa.recommended_items(fa.recommend(model, indexed, 5)).collect()
        lists.append({r.user_index: r.predicted for r in top})
    assert lists[0] == lists[1]


def test_evaluation_equals_the_built_in_evaluators(spark, validation, fitted):
    model, indexes = fitted
    indexed = fa.index_pairs(validation, indexes)
    got = factors.evaluate_factors(model, indexed, 5).first()
    predictions = fa.predict(model, indexed).withColumn("play_count", F.col("play_count").cast("double"))
    expected = RegressionEvaluator(metricName="rmse", labelCol="play_count").evaluate(predictions)
    assert got.rmse == pytest.approx(expected, rel=1e-9)
    actual = predictions.groupBy("user_index").agg(
        F.collect_list(F.col("track_id_index").cast("double")).alias("label")
    )
    predicted = fa.recommended_items(fa.recommend(model, indexed, 5)).select(
        "user_index", F.col("predicted").cast("array<double>").alias("prediction")
    )
    lists = actual.join(predicted, "user_index")
    for ours, theirs in {"map": "meanAveragePrecisionAtK", "precision": "precisionAtK", "ndcg": "ndcgAtK"}.items():
        expected = RankingEvaluator(metricName=theirs, k=5).evaluate(lists)
        assert got[ours] == pytest.approx(expected, abs=1e-12)
    assert got.n_users == lists.count()


def test_all_pairs_count_cold_users_and_items_as_misses(validation, fitted):
    model, indexes = fitted
    indexed = fa.index_pairs(validation, indexes)
    known = factors.evaluate_factors(model, indexed, 5).first()
    everything = factors.evaluate_factors(model, indexed, 5, "all").first()
    assert everything.n_users == 35 and known.n_users == 30
    assert everything.recall < known.recall
    assert everything.rmse == pytest.approx(known.rmse)
    with pytest.raises(ValueError):
        factors.evaluate_factors(model, indexed, 5, "some")


def test_ids_beyond_int_need_a_user_index(spark, ratings):
    big = ratings.withColumn("user_id", F.col("user_id") + 3_000_000_000)
    for ansi in ("true", "false"):
        spark.conf.set("spark.sql.ansi.enabled", ansi)
        with pytest.raises(Exception, match="user id is no int"):
            fa.index_pairs(big, fa.train_indexes(big, index_users=False)).collect()
    spark.conf.unset("spark.sql.ansi.enabled")
    indexes = fa.train_indexes(big)
    indexed = fa.index_pairs(big, indexes)
    model = fa.fit_factors(indexed, PARAMS, blocks=2)
    named = fa.named_rows(fa.ranked_rows(fa.recommend(model, indexed, 2)), indexes)
    assert {r.user_id for r in named.collect()} == {u + 3_000_000_000 for u in range(30)}


@pytest.mark.parametrize("pairs_per_block,items_per_block", [(8192, 8192), (7, 4)])
def test_full_ranks_equal_scoring_everything(ratings, validation, fitted, pairs_per_block, items_per_block):
    model, indexes = fitted
    relevant = fa.index_pairs(validation, indexes).select("user_index", "track_id_index").distinct()
    got = full_rank_sums(model, relevant, pairs_per_block, items_per_block).collect()
    users = {r.id: np.array(r.features, dtype=np.float64) for r in model.userFactors.collect()}
    items = {r.id: np.array(r.features, dtype=np.float64) for r in model.itemFactors.collect()}
    wanted = {}
    for r in relevant.collect():
        if r.user_index in users and r.track_id_index in items:
            wanted.setdefault(r.user_index, []).append(r.track_id_index)

    def score(user, item):
        total = 0.0
        for u, i in zip(users[user], items[item]):
            total += u * i
        return total

    expected = []
    for user, own in wanted.items():
        order = sorted(items, key=lambda item: (-score(user, item), item))
        places = [order.index(item) + 1 for item in own]
        expected.append((user, len(own), sum(places), min(places)))
    assert sorted(tuple(r) for r in got) == sorted(expected)


def test_tuning_keeps_the_best_point_and_reports_all(spark, ratings, validation):
    grid = factors.parameter_grid([2, 3], [0.05], [0.5], [3])
    tuned = factors.tune(ratings, validation, grid, k=5, play_threshold=2, blocks=2)
    rows = tuned.results.collect()
    assert [r["rank"] for r in rows] == [2, 3]
    best = max(rows, key=lambda r: r.map)
    assert tuned.best.rank == best["rank"] and tuned.model.rank == best["rank"]
    assert all(r.fit_seconds > 0 and r.evaluate_seconds > 0 for r in rows)
    by_rmse = factors.tune(ratings, validation, grid, 5, 2, select_by="rmse", blocks=2)
    assert by_rmse.best.rank == min(rows, key=lambda r: r.rmse)["rank"]
    by_index = factors.tune(ratings, validation, grid[:1], 5, 2, index_users=True, blocks=2)
    assert by_index.results.first().n_users == rows[0].n_users
    test = factors.score_test(tuned, validation, 5, 2).first()
    assert test.map == pytest.approx(best.map) and test.n_users == best.n_users


def test_edge_check(spark):
    names = ["rank", "reg", "alpha", "iterations", "map"]
    rows = [(5, 0.1, 1.0, 10, 0.1), (10, 0.1, 1.0, 10, 0.3), (20, 0.1, 2.0, 10, 0.2), (10, 0.1, 2.0, 10, 0.2)]
    got = factors.edge_check(spark.createDataFrame(rows, names)).collect()
    assert {r.parameter: r.on_edge for r in got} == {
        "rank": False, "reg": False, "alpha": True, "iterations": False,
    }


def test_fit_scaling_and_comparison(ratings):
    scaling = comparison.fit_scaling(ratings, PARAMS, [0.5, 1.0]).collect()
    assert scaling[0].n_pairs < scaling[1].n_pairs == ratings.count()
    rows = comparison.compare_models(ratings, PARAMS, 5, 1, 1, 1).collect()
    assert [(r.model, r.side) for r in rows] == [
        (model, side) for model in ("popularity", "factors") for side in ("train", "test")
    ]
    for row in rows:
        for name in comparison.COMPARED:
            assert 0 <= row[name] <= 1
    by = {(r.model, r.side): r for r in rows}
    assert by["factors", "train"].auc > by["popularity", "train"].auc > 0.3


@pytest.mark.parametrize("block_rows", [4096, 3])
def test_hashed_search_finds_the_best_of_each_bucket(monkeypatch, ratings, fitted, block_rows):
    monkeypatch.setattr(nearest, "ROWS_PER_BLOCK", block_rows)
    model, indexes = fitted
    users, items = nearest.hashed_sides(model, fa.index_pairs(ratings, indexes), 2, 0.4)
    got = nearest.search_hashed(users, items, 4).collect()
    in_bucket, factors_of = {}, {}
    for r in items.collect():
        in_bucket.setdefault((r.table, r.bucket), []).append(r.id)
        factors_of[r.id] = r.features
    expected, n_scored = set(), 0
    candidates, user_factors = {}, {}
    for r in users.collect():
        candidates.setdefault(r.id, set()).update(in_bucket.get((r.table, r.bucket), []))
        n_scored += len(in_bucket.get((r.table, r.bucket), []))
        user_factors[r.id] = r.features
    for user, found in candidates.items():
        score = lambda item: sum(u * i for u, i in zip(user_factors[user], factors_of[item]))
        for place, item in enumerate(sorted(found, key=lambda i: (-score(i), i))[:4], 1):
            expected.add((user, item, place))
    assert {(r.user_index, r.track_id_index, r.pos) for r in got} == expected
    assert nearest.scored_pairs(users, items).first()[0] == n_scored


def test_wide_buckets_find_everything_and_narrow_ones_score_less(ratings, fitted):
    model, indexes = fitted
    indexed = fa.index_pairs(ratings, indexes)
    settings = [(1, 1, 1e6), (1, 1, 0.4), (1, 3, 0.4), (12, 3, 0.4)]
    exact, wide, narrow, fine, many = comparison.compare_search(model, indexed, 5, settings).collect()
    assert (exact.method, exact.recall) == ("exact", 1.0)
    # Pieces this wide hold every vector.
    assert wide.recall == 1.0 and wide.scored_share == 1.0
    assert narrow.scored_share > fine.scored_share
    assert many.recall > fine.recall and narrow.recall < 1.0


def test_points_side_by_side_give_the_same_table(spark, ratings, validation):
    grid = factors.parameter_grid([2, 3], [0.05], [0.1, 1.0], [2, 4])

    def table(tuned):
        shown = [c for c in tuned.results.columns if not c.endswith("seconds")]
        return [tuple(r) for r in tuned.results.select(*shown).collect()]

    alone = factors.tune(ratings, validation, grid, 5, 1, blocks=2)
    together = factors.tune(ratings, validation, grid, 5, 1, blocks=2, workers=4)
    assert [pytest.approx(r) for r in table(alone)] == table(together)
    assert alone.best == together.best == max(zip(grid, table(alone), strict=True), key=lambda x: x[1][alone.results.columns.index("map")])[0]


def test_halving_keeps_the_better_half(spark, ratings, validation, monkeypatch):
    grid = factors.parameter_grid([2, 3], [0.05], [0.1, 1.0], [8])
    fitted = []
    fit = factors.fit_factors
    monkeypatch.setattr(factors, "fit_factors", lambda df, p, *a: fitted.append(p) or fit(df, p, *a))
    tuned = factors.tune(ratings, validation, grid, 5, 1, blocks=2, halvings=2)
    assert [p.iterations for p in fitted] == [2] * 4 + [4] * 2 + [8]
    assert tuned.best == fitted[-1] and tuned.results.count() == 1 and tuned.best.iterations == 8


def test_full_ranks_meet_few_user_blocks_at_once(validation, fitted):
    model, indexes = fitted
    relevant = fa.index_pairs(validation, indexes).select("user_index", "track_id_index").distinct()
    item_factors = model.itemFactors.select(F.col("id").alias("track_id_index"), F.col("features").alias("item_features"))
    scored = factor_ranks._scored_pairs(model, relevant, item_factors)
    first = F.max_by("track_id_index", F.struct("score", -F.col("track_id_index"))).alias("first_item")
    pairs = scored.join(scored.groupBy("user_index").agg(F.count(F.lit(1)).alias("n_ranked"), first), "user_index")
    cells = factor_ranks._dealt_cells(model, pairs, relevant, item_factors, 2, 4, 3)
    n_user_blocks = -(-relevant.count() // 2)
    assert n_user_blocks > 3 * 4
    assert cells.groupBy("item_block", "copy").count().agg(F.max("count")).first()[0] <= 3
    few = full_rank_sums(model, relevant, 2, 4, 3).collect()
    assert sorted(few) == sorted(full_rank_sums(model, relevant, 2, 4).collect())


def test_shuffle_files_do_not_grow_with_the_iterations(spark, ratings):
    tracker = spark.sparkContext._jsc.sc().env().mapOutputTracker()
    indexed = fa.index_pairs(ratings, fa.train_indexes(ratings)).cache()
    indexed.count()

    def left():
        return set(tracker.shuffleStatuses().keys().mkString(",").split(","))

    def left_by(iterations):
        gc.collect()
        spark._jvm.System.gc()
        time.sleep(2)
        before = left()
        model = fa.fit_factors(indexed, fa.FactorParams(2, 0.1, 1.0, iterations), blocks=2)
        return len(left() - before), model

    (few, _), (many, _) = left_by(2), left_by(9)
    assert many <= few + 2
    indexed.unpersist()


def test_edge_check_is_over_the_whole_ranges(spark, folder, monkeypatch):
    grids = []

    def tune(train, validation, grid, *args, **more):
        grids.append(list(grid))
        rows = [(p.rank, p.reg, p.alpha, p.iterations, 1.0 if p == factors.FactorParams(50, 0.05, 10.0, 5) else 0.5) for p in grid]
        results = spark.createDataFrame(rows, ["rank", "reg", "alpha", "iterations", "map"])
        return factors.Tuned(results, None, None, None)

    monkeypatch.setattr(factors, "tune", tune)
    found = {r.parameter: r for r in catalogue.tune_edge_check(spark, folder).collect()}
    assert grids == [factors.parameter_grid(factors.RANKS, factors.REGS, factors.ALPHAS, factors.ITERATIONS)]
    assert {name: r.n_values for name, r in found.items()} == {"rank": 5, "reg": 4, "alpha": 4, "iterations": 4}
    assert {name: r.on_edge for name, r in found.items()} == {"rank": False, "reg": False, "alpha": True, "iterations": True}
