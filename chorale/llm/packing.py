"""Documents packed into sequences of fixed length, without conflicts inside a sequence.

A sequence (bin) holds ``capacity`` words. A longer document fills bins of its own and
only its last piece is packed with others. Two pieces of one duplicate cluster never share
a bin, and no more than ``per_source`` pieces of one source do: each open bin carries
bitmaps of the clusters and of the sources in it, exact ones, as bits are given out
anew in each group. Bins are held in the order of their residual room; the search begins
at the first that is large enough and goes on to the next while they conflict, so a piece
gets the tightest bin it may go into, or a new one.

Documents are dealt by hash into groups of about ``group_rows``, whatever their source or
cluster, and each group is packed by itself: memory is bounded by a group's numbers, equal
rows go out in runs of ``copy_run``, each run to another group. Texts are not moved, and what
a group leaves unfilled is small beside its hundreds of bins.

Defined results for odd input: a null text is empty; a document without words is in no
bin (null) with a length of 0; a null source is a source; pieces of one length go in the
order of their ids, and further ties in that of their clusters; equal rows are packed one
by one and are in one cluster. Other columns are left out; an empty table gives an empty
table.
"""

from __future__ import annotations

import math
from bisect import bisect_left, insort
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chorale.session import ship_package

WORD = r"[^\\x20\\x09-\\x0D]+"


@dataclass(frozen=True)
class Packing:
    capacity: int = 2048
    per_source: int = 2
    group_rows: int = 4096
    copy_run: int = 64


class Bins:
    """Open bins by residual room, with the bitmaps of what they hold."""

    def __init__(self, packing: Packing):
        self.packing = packing
        self.order: list[tuple[int, int]] = []  # (residual, bin)
        self.used: list[int] = []
        self.clusters: list[int] = []
        self.sources: list[list[int]] = []  # one bitmap for each piece a source may have

    def conflicts(self, number: int, source: int, cluster: int) -> bool:
        return bool(self.clusters[number] & cluster or self.sources[number][-1] & source)

    def put(self, length: int, source: int, cluster: int) -> tuple[int, int]:
        """The bin for a piece and its offset there. ``source`` and ``cluster`` are single bits."""
        at = bisect_left(self.order, (length, -1))
        while at < len(self.order) and self.conflicts(self.order[at][1], source, cluster):
            at += 1
        if at < len(self.order):
            _, number = self.order.pop(at)
        else:
            number = len(self.used)
            self.used.append(0)
            self.clusters.append(0)
            self.sources.append([0] * self.packing.per_source)
        offset = self.used[number]
        self.used[number] += length
        self.clusters[number] |= cluster
        levels = self.sources[number]
        for k, bitmap in enumerate(levels):
            if not bitmap & source:
                levels[k] |= source
                break
        residual = self.packing.capacity - self.used[number]
        if residual:
            insort(self.order, (residual, number))
        return number, offset


def pack_group(rows: pd.DataFrame, packing: Packing) -> pd.DataFrame:
    """(doc_id, piece, start_word, length, bin, bin_offset) for the documents of one group."""
    source_bits: dict[object, int] = {}
    cluster_bits: dict[object, int] = {}
    bins = Bins(packing)
    out = []
    rows = rows.sort_values(["rest", "doc_id", "cluster"], ascending=[False, True, True], kind="stable")
    for doc_id, source, cluster, n_words, rest in rows[
        ["doc_id", "source", "cluster", "n_words", "rest"]
    ].itertuples(index=False):
        doc_id = None if pd.isna(doc_id) else int(doc_id)
        source = None if pd.isna(source) else source
        if not n_words:
            out.append((doc_id, 0, 0, 0, None, None))
            continue
        full = n_words // packing.capacity
        for piece in range(full):
            number = len(bins.used)
            bins.used.append(packing.capacity)
            bins.clusters.append(0)
            bins.sources.append([])
            out.append((doc_id, piece, piece * packing.capacity, packing.capacity, number, 0))
        if rest:
            bits = (
                1 << table.setdefault(value, len(table))
                for table, value in ((source_bits, source), (cluster_bits, cluster))
            )
            number, offset = bins.put(rest, *bits)
            out.append((doc_id, full, full * packing.capacity, rest, number, offset))
    columns = ["doc_id", "piece", "start_word", "length", "bin", "bin_offset"]
    return pd.DataFrame(out, columns=columns).astype(dict.fromkeys(columns, "Int64"))


def measured(docs: DataFrame) -> DataFrame:
    """(doc_id, source, cluster, n_words): texts equal up to blanks and case are one cluster."""
    text = F.lower(F.coalesce(F.col("text"), F.lit("")))
    plain = F.regexp_replace(text, r"[\x20\x09-\x0D]+", " ")
    return docs.select(
        "doc_id",
        "source",
        F.md5(F.trim(plain)).alias("cluster"),
        F.expr(f"CAST(regexp_count(coalesce(text, ''), '{WORD}') AS BIGINT)").alias("n_words"),
    )


def packed(rows: DataFrame, packing: Packing = Packing()) -> DataFrame:
    """(doc_id, piece, start_word, length, bin_id, bin_offset) for each piece of each document.

    ``rows`` has ``doc_id`` (a whole number), ``source``, ``cluster`` and ``n_words``. They
    are counted first, to know the number of groups.
    """
    ship_package(rows.sparkSession)
    rows = rows.select("doc_id", "source", "cluster", "n_words")
    n_groups = max(1, math.ceil(rows.count() / packing.group_rows))
    # Equal rows are counted, and each run of them is dealt as one: to the next group.
    counted = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("copies"))
    runs = F.sequence(F.lit(0).cast("bigint"), F.expr(f"(copies - 1) div {packing.copy_run}"))
    in_run = F.least(F.col("copies") - F.col("run") * packing.copy_run, F.lit(packing.copy_run))
    rows = counted.withColumn("run", F.explode(runs)).withColumn("in_run", in_run)
    place = F.pmod(F.xxhash64("doc_id", "cluster", "source"), F.lit(n_groups)) + F.col("run")
    group = F.pmod(place, F.lit(n_groups))
    dealt = rows.select(
        group.alias("pack_group"),
        F.col("doc_id").cast("bigint").alias("doc_id"),
        "source",
        "cluster",
        "n_words",
        F.expr(f"n_words % {packing.capacity}").alias("rest"),
        "in_run",
    )

    def pack(key: tuple, own: pd.DataFrame) -> pd.DataFrame:
        own = own.loc[own.index.repeat(own["in_run"])]
        return pack_group(own, packing).assign(pack_group=int(key[0]))

    schema = "pack_group long, doc_id long, piece long, start_word long, length long, bin long, bin_offset long"
    return (
        dealt.groupBy("pack_group")
        .applyInPandas(pack, schema)
        .select(
            "doc_id",
            "piece",
            "start_word",
            "length",
            # Bins of a group are far fewer than 2^32.
            (F.col("pack_group") * F.lit(1 << 32) + F.col("bin")).alias("bin_id"),
            "bin_offset",
        )
    )
