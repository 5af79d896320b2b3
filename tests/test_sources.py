import os
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chorale import __main__ as command
from chorale.plans import loading
from chorale.session import scratch_path, shared_folder
from chorale.sources import adapters, schemas, tables
from chorale.sources.tables import Dataset


def test_conform_casts_drops_and_fills(spark):
    df = spark.createDataFrame([("7", 1.9, "x")], "user_id string, play_count double, other string")
    row = tables.conform(df, schemas.RATINGS).collect()
    assert [tuple(r) for r in row] == [(7, None, 1)]
    assert tables.conform(df, schemas.RATINGS).schema == schemas.RATINGS


def test_only_wanted_columns_are_scanned(spark, tmp_path):
    path = str(tmp_path / "events")
    spark.createDataFrame([(1, "a", 5, "mbid")], "user_id int, recording_msid string, timestamp int, recording_mbid string").write.parquet(path)
    df = tables.read_interactions(spark, path)
    assert df.dtypes == [("user_id", "bigint"), ("recording_msid", "string"), ("timestamp", "int")]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "recording_mbid" not in plan


def test_track_and_user_tables(spark, tmp_path, folder):
    adapters.parts_as_tracks(spark, folder).drop("recording_mbid").write.parquet(f"{tmp_path}/t")
    adapters.customers_as_users(spark, folder).write.parquet(f"{tmp_path}/u")
    tracks = tables.read_tracks(spark, f"{tmp_path}/t")
    assert tracks.schema == schemas.TRACKS and tracks.where("recording_mbid IS NULL").count() == 200
    users = tables.read_users(spark, f"{tmp_path}/u")
    assert users.schema == schemas.USERS and users.count() == 150


def test_seconds_are_a_time_too(spark, tmp_path):
    rows = [(1, item, second) for second, item in enumerate("abcde")]
    spark.createDataFrame(rows, "user_id int, recording_msid string, timestamp int").write.parquet(
        f"{tmp_path}/events"
    )
    counted = loading.split_ratings(tables.read_interactions(spark, f"{tmp_path}/events"))
    assert [r.recording_msid for r in counted.where("NOT is_train").collect()] == ["e"]


def test_materialize_reads_what_is_there(spark, tmp_path):
    path, calls = str(tmp_path / "table"), []

    def build():
        calls.append(1)
        return spark.range(5)

    assert not tables.is_written(spark, path)
    assert tables.materialize(spark, path, build).count() == 5
    assert tables.is_written(spark, path)
    assert tables.materialize(spark, path, build).count() == 5
    assert len(calls) == 1


def test_an_unfinished_write_does_not_count(spark, tmp_path):
    (tmp_path / "half").mkdir()
    assert not tables.is_written(spark, str(tmp_path / "half"))
    assert tables.materialize(spark, str(tmp_path / "half"), lambda: spark.range(3)).count() == 3


def test_split_sides_are_partitions(spark, tmp_path, folder):
    path = str(tmp_path / "split")
    tables.write_split(loading.split_ratings(adapters.events_as_listens(spark, folder)), path)
    train = tables.load_split(spark, path, "train")
    assert train.columns == ["user_id", "recording_msid", "play_count"]
    assert "PartitionFilters: [isnotnull(split" in train._jdf.queryExecution().executedPlan().toString()
    plays = train.unionByName(tables.load_split(spark, path, "validation")).agg({"play_count": "sum"})
    assert plays.first()[0] == 1000


@pytest.mark.parametrize("n_files", [1, 4])
def test_as_many_files_as_asked_for(spark, tmp_path, n_files):
    path = str(tmp_path / "one")
    tables.write_files(spark.range(100).repartition(7), path, n_files)
    assert len([f for f in os.listdir(path) if f.endswith(".parquet")]) == n_files
    assert spark.read.parquet(path).count() == 100


def test_paths_of_a_data_set():
    small, full = Dataset("/in", "/out", "small"), Dataset("/in", "/out")
    assert small.input("interactions") == "/in/interactions_train_small.parquet"
    assert full.input("tracks", "test") == "/in/tracks_test.parquet"
    assert (small.has_test, full.has_test) == (False, True)
    assert small.results == "/out/results_small.csv"
    with pytest.raises(ValueError):
        Dataset("/in", "/out", "medium")


def test_scratch_paths_are_new_and_in_the_shared_folder(spark):
    first, second = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert first != second and first.startswith(shared_folder(spark))


def fake_session(master, **conf):
    get = lambda key, default=None: conf.get(key.replace(".", "_"), default)
    return SimpleNamespace(conf=SimpleNamespace(get=get), sparkContext=SimpleNamespace(master=master))


def test_the_named_checkpoint_folder_is_used():
    session = fake_session("yarn", spark_checkpoint_dir="hdfs:///shared/checkpoints/")
    assert shared_folder(session) == "hdfs:///shared/checkpoints"


def test_a_cluster_without_a_shared_folder_is_an_error():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(fake_session("yarn"))


def write_inputs(spark, root, folder, small):
    listens = adapters.events_as_listens(spark, folder)
    listens.where("timestamp < '2024-01-25'").write.parquet(f"{root}/interactions_train{'_small' if small else ''}.parquet")
    if not small:
        listens.where("timestamp >= '2024-01-25'").write.parquet(f"{root}/interactions_test.parquet")


def test_jobs_from_the_command_line(spark, tmp_path, folder, capsys, monkeypatch):
    root, work = str(tmp_path / "in"), str(tmp_path / "work")
    write_inputs(spark, root, folder, small=False)
    monkeypatch.setattr(command, "build_session", lambda name: spark)

    def run(job, *more):
        command.main([job, "full", "--root", root, "--work", work, "--top", "5", "--min-plays", "2", *more])
        return capsys.readouterr().out

    assert "play_count" in run("prepare")
    out = run("popularity", "--min-users", "5")
    assert "validation" in out and "test" in out
    out = run("tune", "--rank", "2", "--iterations", "2", "3")
    assert "best: FactorParams" in out and "on_edge" in out
    results = spark.read.option("header", True).csv(f"{work}/results.csv")
    assert results.count() == 2 and results.columns == schemas.TUNING_RESULTS.names
    run("sample", "--fraction", "0.5")
    for side in ("train", "validation"):
        files = os.listdir(f"{work}/{side}_sample.parquet")
        assert len([f for f in files if f.endswith(".parquet")]) == 1
    monkeypatch.setattr(command.comparison, "compare_models", lambda *a: spark.range(1))
    run("compare")


def test_the_small_variant_has_no_test_table(spark, tmp_path, folder):
    root = str(tmp_path / "in")
    write_inputs(spark, root, folder, small=True)
    loaded = loading.prepare(spark, Dataset(root, str(tmp_path / "work"), "small"))
    assert set(loaded) == {"train", "validation"}
    assert isinstance(loaded["train"].schema["play_count"].dataType, T.LongType)


def test_changed_input_is_built_again_and_unchanged_is_not(spark, tmp_path):
    source, path, built = str(tmp_path / "in"), str(tmp_path / "out"), []

    def current(**parameters):
        def build():
            built.append(parameters)
            return spark.read.parquet(source)

        return tables.materialize(spark, path, build, tables.manifest(spark, [source], **parameters)).count()

    spark.range(5).write.parquet(source)
    assert [current(ratio=0.8), current(ratio=0.8), len(built)] == [5, 5, 1]
    assert [current(ratio=0.7), current(ratio=0.7), len(built)] == [5, 5, 2]
    spark.range(4).write.mode("append").parquet(source)
    assert [current(ratio=0.7), current(ratio=0.7), len(built)] == [9, 9, 3]
    # The same rows in other files are another input; a write that broke off is made anew.
    spark.range(9).coalesce(1).write.mode("overwrite").parquet(source)
    assert [current(ratio=0.7), len(built)] == [9, 4]
    os.remove(f"{path}/{tables.MANIFEST}")
    assert [current(ratio=0.7), len(built)] == [9, 5]
    os.remove(f"{path}/_SUCCESS")
    assert [current(ratio=0.7), len(built)] == [9, 6]


def test_prepared_tables_follow_their_inputs(spark, tmp_path, folder):
    root = str(tmp_path / "in")
    write_inputs(spark, root, folder, small=False)
    data = Dataset(root, str(tmp_path / "work"))
    first = {name: table.count() for name, table in loading.prepare(spark, data).items()}
    split = f"{data.split(0.8)}/_SUCCESS"
    made = os.stat(split).st_mtime_ns
    again = {name: table.count() for name, table in loading.prepare(spark, data).items()}
    assert again == first and os.stat(split).st_mtime_ns == made
    more = adapters.events_as_listens(spark, folder).where("timestamp < '2024-01-25'").limit(50)
    more.withColumn("event_id", F.col("event_id") + 10**9).withColumn("user_id", F.lit(10**6).cast("bigint")).write.mode(
        "append"
    ).parquet(data.input("interactions"))
    grown = loading.prepare(spark, data)
    assert grown["train"].where("user_id = 1000000").count() > 0
    assert grown["test"].count() == first["test"]
