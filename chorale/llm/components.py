"""Connected components of a table of links."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chorale.session import Workspace

# Links a task holds on average, and tasks among which the links to one node are dealt.
ROWS_PER_TASK = 50_000
SALTS = 16


def _least_below(edges: DataFrame) -> DataFrame:
    """(u, m): the least node that each node is tied to, where that is below itself."""
    return edges.groupBy("u").agg(F.min("v").alias("m"))


def _salt(by: str) -> Column:
    return F.pmod(F.xxhash64(by), F.lit(SALTS)).cast("int")


def _round(edges: DataFrame, tasks: int) -> DataFrame:
    """One step towards stars: nodes tie what they are tied to, and themselves, to the least
    of it; then every node is tied to what its own one is tied to."""
    tied = edges.join(_least_below(edges), "u").coalesce(tasks)
    tied = tied.select(
        F.explode(
            F.when(F.col("v") == F.col("m"), F.array(F.struct("u", F.col("m").alias("v")))).otherwise(
                F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))
            )
        ).alias("e")
    ).select("e.*")
    # The centre of a star is below many nodes, whose links are dealt by both ends for that.
    below = _least_below(tied).coalesce(tasks).select(F.col("u").alias("v"), "m")
    below = below.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    jumped = tied.withColumn("salt", _salt("u")).join(below, ["v", "salt"], "left")
    return jumped.select("u", F.coalesce("m", "v").alias("v")).coalesce(tasks).distinct().coalesce(tasks)


def components(links: DataFrame, a: str, b: str, work: Workspace | None = None) -> DataFrame:
    """(node, component) of every linked node; a component is called by its least node.

    Links are turned into stars step by step until nothing changes, which takes about as
    many rounds as the logarithm of the longest path. Each round is written to ``work`` and
    the one before deleted, so neither lineage nor tables nor lost executors add up; only a
    count and a sum of hashes come to the driver. The result reads the last one, which
    ``work.drop`` of the result deletes.
    """
    work = work or Workspace(links.sparkSession, "components")
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    edges = work.keep(edges.where("u <> v").distinct(), "links")
    seen = None
    while True:
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        seen = now
        tasks = max(1, math.ceil(now[0] / ROWS_PER_TASK))
        after = work.keep(_round(edges, tasks), "stars")
        work.drop(edges)
        edges = after
    roots = edges.select(F.col("v").alias("node")).distinct()
    named = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return work.same(named.unionByName(roots.select("node", F.col("node").alias("component"))), edges)
