"""Command line: ``python -m chorale <job> <small|full> --root DIR --work DIR``."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from chorale.operators.prepare import play_counts, union_all
from chorale.plans import comparison, factors, loading
from chorale.plans.popularity import run_popularity
from chorale.session import build_session, clear_scratch
from chorale.sources.tables import Dataset, read_interactions, write_results


def prepare(spark: SparkSession, data: Dataset, args: argparse.Namespace) -> None:
    for name, table in loading.prepare(spark, data).items():
        print(name)
        table.printSchema()


def popularity(spark: SparkSession, data: Dataset, args: argparse.Namespace) -> None:
    loaded = loading.prepare(spark, data, with_test=True)
    train = loaded.pop("train")
    run_popularity(
        train, loaded, [args.top], args.damping, args.min_users, counted=True
    ).show(truncate=False)


def tune(spark: SparkSession, data: Dataset, args: argparse.Namespace) -> None:
    loaded = loading.prepare(spark, data)
    grid = factors.parameter_grid(args.rank, args.reg, args.alpha, args.iterations)
    tuned = factors.tune(
        loaded["train"],
        loaded["validation"],
        grid,
        args.top,
        args.min_plays,
        args.select_by,
        index_users=not args.raw_user_ids,
    )
    write_results(tuned.results, data.results)
    tuned.results.show(len(grid), truncate=False)
    factors.edge_check(tuned.results, args.select_by).show(truncate=False)
    print("best:", tuned.best)
    if data.has_test:
        factors.score_test(tuned, loaded["test"], args.top, args.min_plays).show(truncate=False)


def sample(spark: SparkSession, data: Dataset, args: argparse.Namespace) -> None:
    loading.write_samples(loading.prepare(spark, data), data, args.fraction)


def compare(spark: SparkSession, data: Dataset, args: argparse.Namespace) -> None:
    events = union_all(
        read_interactions(spark, data.input("interactions")),
        read_interactions(spark, data.input("interactions", "test")),
    )
    params = factors.FactorParams(args.rank[0], args.reg[0], args.alpha[0], args.iterations[0])
    comparison.compare_models(
        play_counts(events), params, args.top, args.min_plays, args.damping, args.min_users
    ).show(truncate=False)


JOBS = {job.__name__: job for job in (prepare, popularity, tune, sample, compare)}


def parse(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="chorale")
    parser.add_argument("job", choices=JOBS)
    parser.add_argument("variant", choices=["small", "full"])
    parser.add_argument("--root", required=True, help="folder of the input tables")
    parser.add_argument("--work", required=True, help="folder for derived tables")
    parser.add_argument("--top", type=int, default=100)
    parser.add_argument("--damping", type=float, default=200)
    parser.add_argument("--min-users", type=int, default=30)
    parser.add_argument("--min-plays", type=int, default=30)
    parser.add_argument("--fraction", type=float, default=0.01)
    parser.add_argument("--rank", type=int, nargs="+", default=[10])
    parser.add_argument("--reg", type=float, nargs="+", default=[0.05])
    parser.add_argument("--alpha", type=float, nargs="+", default=[0.1])
    parser.add_argument("--iterations", type=int, nargs="+", default=[20])
    parser.add_argument("--select-by", choices=["map", "precision", "ndcg", "rmse"], default="map")
    parser.add_argument("--raw-user-ids", action="store_true", help="user ids are ints already")
    return parser.parse_args(argv)


def main(argv: list[str] | None = None) -> None:
    args = parse(argv)
    spark = build_session(f"chorale-{args.job}")
    try:
        JOBS[args.job](spark, Dataset(args.root, args.work, args.variant), args)
    finally:
        clear_scratch(spark)


if __name__ == "__main__":
    main()
