from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from chorale.operators.prepare import clean_interactions, play_counts
from chorale.operators.splits import (
    split_by_user_time,
    split_random_pairs,
    split_random_rows,
    tag_by_user_time,
)
from chorale.plans.loading import split_ratings

SCHEMA = "user_id bigint, recording_msid string, timestamp int"


def rows_of(df):
    return Counter(tuple(r) for r in df.collect())


def test_a_user_with_one_event_is_in_validation(spark):
    df = spark.createDataFrame([(1, "a", 5)], SCHEMA)
    train, validation = split_by_user_time(df)
    assert train.count() == 0 and validation.count() == 1


def test_equal_times_go_by_item(spark):
    df = spark.createDataFrame([(1, item, 9) for item in "edcba"], SCHEMA)
    train, validation = split_by_user_time(df)
    assert sorted(r.recording_msid for r in train.collect()) == list("abcd")
    assert [r.recording_msid for r in validation.collect()] == ["e"]


def test_nulls_are_dropped_and_an_absent_column_is_no_error(spark):
    rows = [(1, "a", 1), (None, "a", 1), (1, None, 1), (1, "a", None)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert rows_of(clean_interactions(df)) == Counter([(1, "a", 1)])
    with_mbid = df.withColumn("recording_mbid", F.lit(None).cast("string"))
    assert rows_of(clean_interactions(with_mbid)) == Counter([(1, "a", 1)])


def test_events_without_a_user_belong_to_neither_side(spark):
    df = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (None, "a", 1)], SCHEMA)
    assert tag_by_user_time(df).count() == 2


EVENTS = st.lists(
    st.tuples(st.integers(0, 3), st.sampled_from("abc"), st.integers(0, 4)), min_size=1, max_size=60
)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=EVENTS)
def test_sides_are_the_input_cut_at_the_same_place_either_way(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    train, validation = (rows_of(side) for side in split_by_user_time(df))
    assert train + validation == Counter(rows)
    for user in {r[0] for r in rows}:
        own = sorted(((t, i) for u, i, t in rows if u == user))
        cut = int(len(own) * 0.8)
        assert Counter((i, t) for t, i in own[:cut]) == Counter(
            (i, t) for u, i, t in train.elements() if u == user
        )
    counted = split_ratings(df).agg(F.sum("play_count")).first()[0]
    assert counted == len(rows)


def test_random_pairs_are_repeatable_and_near_the_fraction(spark):
    df = spark.range(4000).select(
        (F.col("id") % 40).alias("user_id"), F.col("id").cast("string").alias("recording_msid")
    )
    train, test = split_random_pairs(df, 0.2, seed=3)
    again, _ = split_random_pairs(df.repartition(3), 0.2, seed=3)
    other, _ = split_random_pairs(df, 0.2, seed=4)
    assert rows_of(train) == rows_of(again) != rows_of(other)
    assert train.count() + test.count() == 4000
    assert 650 < test.count() < 950


def test_random_rows_cover_the_input(spark):
    df = spark.range(1000).cache()
    train, validation = split_random_rows(df)
    assert train.count() + validation.count() == 1000
    assert train.intersect(validation).count() == 0


def test_plays_add_up_to_events(spark):
    df = spark.createDataFrame([(1, "a", 1), (1, "a", 2), (2, "a", 1)], SCHEMA)
    assert rows_of(play_counts(df)) == Counter([(1, "a", 2), (2, "a", 1)])


def test_train_validation_and_test_share_no_event(spark, folder):
    from chorale.plans import catalogue

    train, validation = catalogue.sides(spark, folder)
    ids = [{r.event_id for r in df.select("event_id").collect()} for df in (train, validation)]
    ids.append({r.event_id for r in catalogue.held_out(spark, folder).select("event_id").collect()})
    assert all(ids) and not (ids[0] & ids[1] or ids[0] & ids[2] or ids[1] & ids[2])
    assert len(set.union(*ids)) == catalogue.listens(spark, folder).count()
