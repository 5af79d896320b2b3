"""Evaluation and tuning of the factor model."""

from __future__ import annotations

import itertools
import math
import time
from collections import deque
from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass, replace

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml.recommendation import ALSModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chorale.columns import ITEM_INDEX, PLAYS, USER, USER_INDEX
from chorale.operators.factors import (
    FactorParams,
    Indexes,
    fit_factors,
    index_pairs,
    predict,
    predict_all,
    train_indexes,
)
from chorale.operators.item_search import best_items
from chorale.operators.metrics import mean_metrics, user_hits
from chorale.operators.prepare import min_plays
from chorale.session import Workspace, scratch_path
from chorale.sources.schemas import TUNING_RESULTS
from chorale.sources.tables import write_table

# The hyper-parameter ranges to tune over.
RANKS = (10, 50, 100, 150, 200)
REGS = (0.01, 0.05, 0.1, 0.2)
ALPHAS = (0.1, 1.0, 5.0, 10.0)
ITERATIONS = (5, 10, 15, 20)


@dataclass(frozen=True)
class Tuned:
    """The results of a grid, its best point by the chosen metric, and that point's model."""

    results: DataFrame
    best: FactorParams
    model: ALSModel
    indexes: Indexes


def parameter_grid(
    ranks: Iterable[int] = RANKS,
    regs: Iterable[float] = REGS,
    alphas: Iterable[float] = ALPHAS,
    iterations: Iterable[int] = ITERATIONS,
) -> list[FactorParams]:
    """All combinations."""
    return [FactorParams(*point) for point in itertools.product(ranks, regs, alphas, iterations)]


def evaluate_factors(
    model: ALSModel,
    indexed: DataFrame,
    k: int = 100,
    relevant: str = "known",
    lists: DataFrame | None = None,
) -> DataFrame:
    """One row: rmse, map, precision, ndcg, recall at k and n_users.

    ``known`` takes as relevant the pairs whose user and item the model knows;
    ``all`` takes every pair, so that unknown users and items count as misses.
    The error is over the known pairs in both cases. ``lists`` are the users' best items where
    they are there already.
    """
    if relevant not in ("known", "all"):
        raise ValueError(f"relevant must be 'known' or 'all', not {relevant!r}")
    scored = predict_all(model, indexed)
    known = scored.where(F.col("prediction").isNotNull())
    error = F.col(PLAYS).cast("double") - F.col("prediction").cast("double")
    extra = [
        F.sum(error * error).alias("square_error"),
        F.count("prediction").alias("n_predicted"),
    ]
    if lists is None:
        lists = best_items(model, known, k)
    # Unknown users may share one number, so users are told apart by their id.
    ranked = lists.join(known.select(USER, USER_INDEX).distinct(), USER_INDEX)
    pairs = known if relevant == "known" else scored
    per_user = user_hits(pairs, ranked, k, user=USER, item=ITEM_INDEX, extra=extra)
    errors = ["square_error", "n_predicted"]
    rmse = F.sqrt(F.sum("square_error") / F.nullif(F.sum("n_predicted"), F.lit(0))).alias("rmse")
    return mean_metrics(per_user, [k], keep=errors, extra=[rmse]).select(
        "k", "n_users", "rmse", "map", "precision", "ndcg", "recall"
    )


def evaluate_both(model: ALSModel, indexed: DataFrame, k: int = 100) -> DataFrame:
    """Both readings of ``evaluate_factors`` with their name in ``relevant``; items are scored once."""
    known = predict(model, indexed)
    lists = Workspace(indexed.sparkSession, "lists").keep(best_items(model, known, k), "best")
    rows = [
        evaluate_factors(model, indexed, k, name, lists).withColumn("relevant", F.lit(name))
        for name in ("known", "all")
    ]
    return rows[0].unionByName(rows[1])


def written_indexes(indexes: Indexes) -> Indexes:
    """The index tables, written to the shared folder: every later step looks numbers up
    in them, and none should number the items anew."""
    spark = indexes.items.sparkSession

    def written(index: DataFrame) -> DataFrame:
        path = scratch_path(spark, "index")
        write_table(index, path)
        return spark.read.parquet(path)

    users = None if indexes.users is None else written(indexes.users)
    return Indexes(written(indexes.items), users)


def tune(
    train: DataFrame,
    validation: DataFrame,
    grid: Sequence[FactorParams],
    k: int = 100,
    play_threshold: int = 30,
    select_by: str = "map",
    index_users: bool = True,
    seed: int = 1,
    blocks: int | None = None,
    workers: int = 1,
    halvings: int = 0,
) -> Tuned:
    """Fit and score every grid point and keep the best by ``select_by``.

    Up to ``workers`` points run side by side, each as a distributed fit in a scheduler pool of
    its own (with ``spark.scheduler.mode`` FAIR they share the executors evenly); the driver holds one
    row of numbers per point, and the results are those of one after the other. ``rmse`` is better
    when lower, the other metrics when higher.

    With ``halvings``, all points are first tried with ``iterations / 2^halvings``, the worse half is
    given up, and the rest goes on with twice as many until the last round fits in full; only
    points of the last round are in the results.
    """
    kept_train = min_plays(train, play_threshold)
    indexes = written_indexes(train_indexes(kept_train, index_users))
    indexed_train = index_pairs(kept_train, indexes).persist(StorageLevel.MEMORY_AND_DISK)
    indexed_validation = index_pairs(min_plays(validation, play_threshold), indexes).persist(
        StorageLevel.MEMORY_AND_DISK
    )
    context = train.sparkSession.sparkContext

    def run(number: int, params: FactorParams) -> tuple[dict, ALSModel]:
        context.setLocalProperty("spark.scheduler.pool", f"point-{number}")
        started = time.perf_counter()
        model = fit_factors(indexed_train, params, seed, blocks)
        fitted = time.perf_counter()
        scores = evaluate_factors(model, indexed_validation, k).first()
        row = {
            **asdict(params),
            **(scores.asDict() if scores else {}),
            "fit_seconds": fitted - started,
            "evaluate_seconds": time.perf_counter() - fitted,
        }
        return row, model

    def run_all(points: Sequence[FactorParams]) -> tuple[list[dict], int | None, ALSModel | None]:
        """The row of each point, the first of the best ones as they stand in the grid, and its
        model; the factors of the others are let go as their turn comes."""
        # Filled before, so that points do not fill the cache at the same time.
        indexed_train.count(), indexed_validation.count()
        rows, best, kept = [], None, None
        with ThreadPoolExecutor(max(1, workers)) as pool:
            jobs = deque(pool.submit(inheritable_thread_target(run), n, point) for n, point in enumerate(points))
            while jobs:
                row, model = jobs.popleft().result()
                rows.append(row)
                if best is None or _goodness(row, select_by) > _goodness(rows[best], select_by):
                    best, kept = len(rows) - 1, model
        return rows, best, kept

    try:
        points = list(grid)
        for left in range(halvings, 0, -1):
            short = [replace(p, iterations=max(1, p.iterations >> left)) for p in points]
            scores = [_goodness(row, select_by) for row in run_all(short)[0]]
            ranked = sorted(range(len(points)), key=lambda n: (-scores[n], n))
            points = [points[n] for n in sorted(ranked[: math.ceil(len(points) / 2)])]
        found, best, model = run_all(points)
    finally:
        indexed_train.unpersist()
        indexed_validation.unpersist()
    rows = [[row.get(name) for name in TUNING_RESULTS.names] for row in found]
    results = train.sparkSession.createDataFrame(rows, TUNING_RESULTS)
    if best is None:
        return Tuned(results, None, None, indexes)
    return Tuned(results, points[best], model, indexes)


def _goodness(row: dict, select_by: str) -> float:
    value = row.get(select_by)
    if value is None:
        return float("-inf")
    return -value if select_by == "rmse" else value


def score_test(tuned: Tuned, test: DataFrame, k: int = 100, play_threshold: int = 30) -> DataFrame:
    """Metrics of the tuned model on a held-out table, with the train side's indexes."""
    indexed = index_pairs(min_plays(test, play_threshold), tuned.indexes)
    return evaluate_factors(tuned.model, indexed, k)


def edge_check(results: DataFrame, select_by: str = "map") -> DataFrame:
    """(parameter, chosen, low, high, n_values, on_edge): whether the best point lies at
    the end of a range that has more than one value."""
    names = ["rank", "reg", "alpha", "iterations"]
    better = F.desc(select_by) if select_by != "rmse" else F.asc(select_by)
    best = results.orderBy(better, *names).limit(1)
    spans = results.agg(
        *[
            F.struct(
                F.min(name).cast("double").alias("low"),
                F.max(name).cast("double").alias("high"),
                F.count_distinct(name).alias("n_values"),
            ).alias(name)
            for name in names
        ]
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("parameter"),
                F.col(name).cast("double").alias("chosen"),
                spans.select(name).scalar().alias("span"),
            )
            for name in names
        ]
    )
    chosen = F.col("chosen")
    at_end = (chosen == F.col("span.low")) | (chosen == F.col("span.high"))
    return (
        best.select(F.explode(rows).alias("row"))
        .select("row.*")
        .withColumn("on_edge", (F.col("span.n_values") > 1) & at_end)
        .select("parameter", "chosen", "span.*", "on_edge")
    )
