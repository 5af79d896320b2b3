"""The physical plans stay the ones that hold at scale."""

import re

import pytest

from chorale.operators import popularity
from chorale.operators.metrics import ranking_metrics, relevant_pairs
from chorale.operators.prepare import play_counts, with_play_count
from chorale.operators.skew import with_global_positions
from chorale.operators.splits import tag_by_user_time
from chorale.plans.loading import split_ratings
from chorale.sources import adapters


def run_plan(df):
    """The plan as it was after the run."""
    df.collect()
    return plan(df).split("Initial Plan")[0]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_splits_shuffle_the_events_once(spark, folder):
    """They are read for the sketch, a row in a few, and for the rows; what is summed up over
    slices comes from the shuffle of the rows."""
    listens = adapters.events_as_listens(spark, folder)
    for df in (tag_by_user_time(listens), split_ratings(listens)):
        final = run_plan(df)
        assert final.count("FileScan") <= 2
        assert len(re.findall(r"Exchange hashpartitioning\(user_id#\d+L, __slice", final)) == 1
        assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,props:string>" in final


def test_nothing_runs_before_the_result_is_asked_for(spark, folder):
    listens = adapters.events_as_listens(spark, folder)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("planning", "planning")
    split_ratings(listens), with_play_count(listens), tag_by_user_time(listens)
    jobs = tracker.getJobIdsForGroup("planning")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert not jobs


def test_only_needed_columns_are_read(spark, folder):
    text = plan(play_counts(adapters.events_as_listens(spark, folder)))
    assert "ReadSchema: struct<user_id:bigint,props:string>" in text


def test_counted_pairs_are_scored_with_one_shuffle_by_user(spark, tmp_path, folder):
    path = str(tmp_path / "ratings")
    play_counts(adapters.events_as_listens(spark, folder)).write.parquet(path)
    ratings = spark.read.parquet(path)
    top = popularity.popularity_top(popularity.popularity_scores(ratings, 200, 5), 10)
    top.write.parquet(f"{path}-top")
    text = plan(
        ranking_metrics(relevant_pairs(ratings, counted=True), spark.read.parquet(f"{path}-top"), [10])
    )
    assert len(re.findall(r"Exchange hashpartitioning\(user_id", text)) == 1
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


def test_no_cartesian_product_anywhere(spark, folder):
    from chorale.plans import catalogue

    for name in ("recommend_popular", "metrics_popularity", "metrics_auc_mrr", "indexed_ratings"):
        text = plan(catalogue.QUERIES[name](spark, folder))
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name


def test_global_positions_never_gather_the_rows(spark):
    """Only the bounds and the piece sizes go through a single partition."""
    df = spark.range(1000).withColumnRenamed("id", "n")
    text = plan(with_global_positions(df, ["n"]))
    for part in re.split(r"Exchange SinglePartition", text)[1:]:
        assert re.match(r"[^\n]*\n[^\n]*(HashAggregate|ObjectHashAggregate)", part), part[:300]


@pytest.mark.parametrize("top_n", [5])
def test_top_n_is_taken_without_a_full_sort(spark, folder, top_n):
    listens = adapters.events_as_listens(spark, folder)
    text = plan(popularity.popularity_top(popularity.popularity_scores(listens, 200, 5), top_n))
    assert "TakeOrderedAndProject" in text
