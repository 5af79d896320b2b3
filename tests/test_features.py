from pyspark.ml.feature import StringIndexer
from pyspark.sql import functions as F

from chorale.operators.features import apply_index, first_seen_index, frequency_index
from chorale.operators.lists import relevant_lists, top_n_per_user
from chorale.operators.popularity import (
    popularity_ranking,
    popularity_scores,
    popularity_top,
    recommend_popular,
)

RATINGS = "user_id bigint, recording_msid string, play_count bigint"


def table(spark):
    rows = [(u, f"i{(u * 7 + k * k) % 13}", k + 1) for u in range(30) for k in range(5)]
    return spark.createDataFrame(rows, RATINGS)


def test_frequency_index_equals_the_string_indexer(spark):
    df = table(spark)
    probe = df.select("recording_msid").distinct().union(
        spark.createDataFrame([("unseen",), (None,)], "recording_msid string")
    )
    indexer = StringIndexer(inputCol="recording_msid", outputCol="n", handleInvalid="keep").fit(df)
    expected = {r.recording_msid: int(r.n) for r in indexer.transform(probe).collect()}
    got = apply_index(probe, frequency_index(df)).collect()
    assert {r.recording_msid: r.track_id_index for r in got} == expected


def test_dropping_unseen_items(spark):
    df = table(spark)
    probe = spark.createDataFrame([(1, "i0", 1), (1, "unseen", 1), (1, None, 1)], RATINGS)
    got = apply_index(probe, frequency_index(df), unseen="drop").collect()
    assert [r.recording_msid for r in got] == ["i0"]


def test_first_seen_index(spark):
    rows = [(1, "c", 3), (1, "a", 5), (2, "b", 3), (2, "c", 9)]
    df = spark.createDataFrame(rows, "user_id bigint, recording_msid string, timestamp int")
    order = first_seen_index(df).orderBy("track_id_index").collect()
    assert [r.recording_msid for r in order] == ["b", "c", "a"]
    by_row = first_seen_index(df, seen_by="user_id").orderBy("track_id_index").collect()
    assert [r.recording_msid for r in by_row] == ["a", "c", "b"]


def test_popularity_of_events_and_of_pairs_agree(spark):
    events = table(spark).withColumn("copy", F.explode(F.sequence(F.lit(1), "play_count")))
    from_pairs = popularity_scores(table(spark), 10, 3).orderBy("recording_msid").collect()
    from_events = popularity_scores(events.drop("play_count"), 10, 3)
    assert from_events.orderBy("recording_msid").collect() == from_pairs
    for row in from_pairs:
        assert row.user_count >= 3
        assert row.avg_listen_per_user == row.listen_count / (row.user_count + 10)


def test_a_cut_inside_a_tie_goes_by_item(spark):
    rows = [(u, item, 1) for item in "dbca" for u in range(3)]
    scores = popularity_scores(spark.createDataFrame(rows, RATINGS), 0, 1)
    assert [r.recording_msid for r in popularity_top(scores, 2).orderBy("pos").collect()] == ["a", "b"]
    ranking = popularity_ranking(scores).orderBy("pos").collect()
    assert [(r.recording_msid, r.pos) for r in ranking] == [("a", 1), ("b", 2), ("c", 3), ("d", 4)]


def test_every_user_gets_the_same_list(spark):
    top = popularity_top(popularity_scores(table(spark), 1, 1), 5)
    expected = [r.recording_msid for r in top.orderBy("pos").collect()]
    users = spark.createDataFrame([(1,), (99,)], "user_id bigint")
    assert [r.predicted for r in recommend_popular(users, top).collect()] == [expected] * 2
    assert [r.predicted for r in recommend_popular(users, top, 2).collect()] == [expected[:2]] * 2


def test_long_lists_go_on_in_parts(spark):
    rows = [(1, f"i{n:03d}", 1) for n in range(100)] + [(2, "b", 1), (2, "a", 1), (2, "a", 1)]
    df = spark.createDataFrame(rows, RATINGS)
    got = relevant_lists(df, list_rows=10).collect()
    assert [r.actual for r in got if r.user_id == 2] == [["a", "b"]]
    own = sorted((r.part, r.actual) for r in got if r.user_id == 1)
    parts = [actual for _, actual in own]
    assert [part for part, _ in own] == list(range(10)) and all(len(p) == 10 for p in parts)
    assert sum(parts, []) == [f"i{n:03d}" for n in range(100)]
    assert [r.actual for r in relevant_lists(df).where("user_id = 1").collect()] == [sum(parts, [])]


def test_top_n_per_user_limits_each_task_first(spark):
    top = top_n_per_user(table(spark), 2)
    assert "WindowGroupLimit" in top._jdf.queryExecution().executedPlan().toString()
    one = top.where("user_id = 3").orderBy("pos").collect()
    assert [r.play_count for r in one] == [5, 4]
