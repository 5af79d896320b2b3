import random
import statistics

from pyspark.sql import functions as F

from chorale.columns import ITEM
from chorale.operators import popularity
from chorale.plans import comparison

EVENTS = "user_id bigint, recording_msid string, timestamp bigint"


def events(spark):
    draw = random.Random(4)
    rows = [(draw.randrange(3000), f"i{min(draw.randrange(9), draw.randrange(9))}", draw.randrange(10 * 86_400)) for _ in range(20_000)]
    rows += [(None, "i0", 5), (3, None, 5), (7, "rare", 86_400), (7, "rare", 9 * 86_400)]
    return spark.createDataFrame(rows, EVENTS)


def rows_of(df):
    return {r[ITEM]: (r.listen_count, r.user_count) for r in df.collect()}


def test_days_give_the_whole_within_the_sketches_error(spark, tmp_path):
    all_events = events(spark)
    exact = rows_of(popularity.popularity_scores(all_events, user_threshold=1))
    path = str(tmp_path / "states")
    for day in range(10):
        one = all_events.where(F.floor(F.col("timestamp") / 86_400) == day)
        popularity.daily_state(one).write.mode("append").parquet(path)
    for size in (64, 4096):
        whole = rows_of(popularity.scores_of_days(popularity.daily_state(all_events, size), 100, 1, size))
        if size == 4096:
            states = spark.read.parquet(path)
            assert rows_of(popularity.scores_of_days(states, user_threshold=1)) == whole == exact
        assert whole.keys() == exact.keys() and whole["rare"] == (2, 1)
        for item, (n_listens, n_users) in exact.items():
            assert whole[item][0] == n_listens
            assert abs(whole[item][1] - n_users) <= 5 * n_users / (size - 2) ** 0.5
    assert exact["i0"][1] > 20 * 64


def test_thresholds_and_empty_states(spark):
    states = popularity.daily_state(events(spark))
    assert "rare" not in rows_of(popularity.scores_of_days(states, user_threshold=2))
    assert popularity.scores_of_days(states.limit(0)).collect() == []


def test_errors_of_replicates(spark):
    draw = random.Random(8)
    pairs = {(u, f"i{draw.randrange(20)}") for u in range(200) for _ in range(9)}
    ratings = spark.createDataFrame([(*p, draw.randrange(1, 5)) for p in sorted(pairs)], "user_id bigint, recording_msid string, play_count bigint")
    replicates = comparison.split_stability(ratings, [1, 2, 3, 4], [3, 5], user_threshold=5)
    found = {r.k: r for r in comparison.stability_errors(replicates).collect()}
    rows = replicates.collect()
    assert sorted((r.seed, r.k) for r in rows) == [(s, k) for s in (1, 2, 3, 4) for k in (3, 5)]
    for k, row in found.items():
        for name in ("map", "precision", "ndcg", "recall"):
            values = [r[name] for r in rows if r.k == k]
            assert abs(row[name] - statistics.mean(values)) < 1e-12
            assert abs(row[f"{name}_error"] - statistics.stdev(values) / 2) < 1e-12


def test_stability_reads_the_ratings_once(spark, folder, tmp_path):
    path = str(tmp_path / "ratings")
    spark.createDataFrame([(u, f"i{u % 7}", 2) for u in range(100)], "user_id bigint, recording_msid string, play_count bigint").write.parquet(path)
    replicates = comparison.split_stability(spark.read.parquet(path), [1, 2], [2], user_threshold=1)
    replicates.collect()
    plan = replicates._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert path not in plan and plan.count("FileScan") <= 2
