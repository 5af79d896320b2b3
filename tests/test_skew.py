import random
from bisect import bisect_right

import pytest
from pyspark.sql import functions as F

from chorale.functions.search import count_at_most
from chorale.operators import skew
from chorale.operators.skew import (
    day_of,
    with_earlier,
    with_global_positions,
    with_key_rows,
    with_positions,
)


def skewed_rows(seed=3):
    """One user with a third of the rows, ties in time, and many copies of one row."""
    draw = random.Random(seed)
    rows = [(1, draw.randrange(20), f"i{draw.randrange(6)}") for _ in range(60)]
    rows += [(1, 7, "copy")] * 45
    rows += [(draw.randrange(2, 40), draw.randrange(5), f"i{draw.randrange(6)}") for _ in range(150)]
    return rows


def expected_positions(rows):
    found, seen = [], {}
    for row in sorted(rows):
        seen[row[0]] = seen.get(row[0], 0) + 1
        found.append((*row, seen[row[0]]))
    return sorted((*r, seen[r[0]]) for r in found)


@pytest.mark.parametrize("copy_run", [4, 100_000])
@pytest.mark.parametrize("pieces", [1, 9, 64])
def test_positions_equal_brute_force(spark, monkeypatch, pieces, copy_run):
    monkeypatch.setattr(skew, "COPY_RUN", copy_run)
    rows = skewed_rows()
    df = spark.createDataFrame(rows, "user int, time int, item string")
    got = with_positions(df, ["user"], ["time"], pieces=pieces).collect()
    assert sorted(tuple(r) for r in got) == expected_positions(rows)


def test_positions_of_rows_without_copies(spark):
    rows = sorted(set(skewed_rows()))
    df = spark.createDataFrame(rows, "user int, time int, item string")
    got = with_positions(df, ["user"], ["time"], distinct=True, pieces=16).collect()
    assert sorted(tuple(r) for r in got) == expected_positions(rows)


def plain_earlier(rows):
    """Sum, total and greatest value of the earlier rows of a key, row by row."""
    found, sums, greatest, totals = [], {}, {}, {}
    for key, _, n in rows:
        totals[key] = totals.get(key, 0) + n
    for key, place, n in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1])):
        found.append((key, place, n, sums.get(key, 0), totals[key], greatest.get(key)))
        sums[key] = sums.get(key, 0) + n
        greatest[key] = max(greatest.get(key, n), n)
    return found


@pytest.mark.parametrize("pieces", [1, 16, 300])
def test_sums_and_maxima_of_earlier_rows(spark, pieces):
    draw = random.Random(11)
    rows = [(draw.choice([None, 1, 1, 1, 2, 3]), k, draw.randrange(1, 50)) for k in range(400)]
    df = spark.createDataFrame(rows, "key int, place int, n int")
    got = with_earlier(df, ["key"], ["place"], {"so_far": "n"}, {"greatest": "n"}, pieces).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, plain_earlier(rows)))
    none = with_earlier(df.limit(0), ["key"], ["place"], {"so_far": "n"}, pieces=pieces)
    assert none.collect() == [] and none.columns == [*df.columns, "so_far", "so_far_total"]


def test_one_second_of_one_user_is_spread_over_tasks(spark):
    """A third of all rows are one user's in one second; no window holds a good part of them."""
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("user"),
        F.lit(7).alias("time"),
        F.col("id").alias("event"),
    )
    placed = with_positions(df, ["user"], ["time"], distinct=True, pieces=64)
    hot = placed.where("user = 0").orderBy("event").collect()
    assert [r.position for r in hot] == list(range(1, 10_001))
    assert {r.key_rows for r in hot} == {10_000}
    sliced = skew._sliced(df, ["user"], ["time", "event"], 64)
    slices = [r["count"] for r in sliced.groupBy("user", "__slice").count().collect()]
    assert sum(slices) == 30_000 and max(slices) < 10_000 / 4


def test_days_rise_with_times_of_all_kinds(spark):
    df = spark.sql(
        "SELECT id * 7000 AS seconds, timestamp_seconds(id * 7000) AS at, to_date(timestamp_seconds(id * 7000)) AS day,"
        " string(timestamp_seconds(id * 7000)) AS text FROM range(60)"
    )
    rows = df.select("seconds", *[day_of(df, c).alias(c + "_day") for c in df.columns]).orderBy("seconds").collect()
    for column in df.columns:
        days = [r[column + "_day"] for r in rows]
        assert days == sorted(days) and 4 <= len(set(days)) <= 6


def test_key_rows_equal_brute_force(spark):
    rows = skewed_rows()
    df = spark.createDataFrame(rows, "user int, time int, item string")
    got = with_key_rows(df, ["user", "item"], "n").collect()
    counts = {}
    for user, _, item in rows:
        counts[user, item] = counts.get((user, item), 0) + 1
    assert sorted(tuple(r) for r in got) == sorted((*r, counts[r[0], r[2]]) for r in rows)


@pytest.mark.parametrize("pieces", [1, 7, 1024])
def test_global_positions_equal_sorting(spark, pieces):
    draw = random.Random(5)
    rows = [(-draw.randrange(4), f"{draw.randrange(10**6)}-{n}") for n in range(500)]
    df = spark.createDataFrame(rows, "down int, item string")
    got = with_global_positions(df, ["down", "item"], pieces).orderBy("position").collect()
    assert [(r.down, r.item) for r in got] == sorted(rows)
    assert [r.position for r in got] == list(range(1, 501))


def test_global_positions_of_an_empty_table(spark):
    df = spark.createDataFrame([], "down int, item string")
    assert with_global_positions(df, ["down", "item"]).count() == 0


def test_no_task_sorts_the_whole_table(spark):
    """Rows of the busiest window partition stay a small part of all rows."""
    df = spark.range(20_000).select(F.col("id").alias("n"))
    bounds = skew._spread_picks(df, F.lit(64), ["n"])
    cuts = sorted(r.pick.n for r in bounds.collect())
    widths = [b - a for a, b in zip([0, *cuts], [*cuts, 20_000])]
    assert max(widths) < 20_000 / 5


def test_binary_search(spark):
    cases = [([], 3), ([1], 0), ([1], 1), ([1, 3, 3, 9], 3), (list(range(0, 200, 3)), 100)]
    df = spark.createDataFrame(cases, "bounds array<int>, key int")
    got = df.select(count_at_most(F.col("bounds"), F.col("key")).alias("n")).collect()
    assert [r.n for r in got] == [bisect_right(bounds, key) for bounds, key in cases]
