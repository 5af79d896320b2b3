"""Shards by a consistent-hash ring with virtual nodes and bounded loads.

The ring has a fixed number of slots. Each shard owns ``points`` of them by hash, and a
key belongs to the first shard found clockwise from the slot of its own hash. Shards
have a capacity; keys that overflow a full shard go on clockwise to the next one with
room. With ``slack`` 0 the capacities add up to exactly the number of rows, so all shards
fill up and their row counts differ by one at most. With more slack fewer keys overflow,
and adding a shard moves fewer of them.

Only the number of rows of each slot matters for where keys go, so those counts, at
most ``slots`` of them, are what one task settles; a slot's rows are then numbered, and
the numbers tell which rows go on. Nothing else is brought together: every window
spans one slot, and rows equal in id and content are counted as one until the end.

Defined results for odd input: a null text is empty for size and checksum; a null id is
an id; equal rows take neighbouring places; an empty table gives an empty table. Columns
beside the keys are left out of the result.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chorale.session import ship_package

# Copies of one row are written out in runs of this length.
RUN = 100_000


@dataclass(frozen=True)
class Ring:
    """``slack`` is the share by which a shard may exceed the mean number of rows."""

    shards: int
    points: int = 128
    slots: int = 1 << 16
    slack: float = 0.0

    def capacities(self, rows: int) -> np.ndarray:
        if self.slack > 0:
            return np.full(self.shards, int(np.ceil((1 + self.slack) * rows / self.shards)))
        each, over = divmod(rows, self.shards)
        return each + (np.arange(self.shards) < over).astype(np.int64)

    def walks(self) -> tuple[np.ndarray, np.ndarray]:
        """The arc that each slot lies in, and for each arc all shards in clockwise order."""
        owned = sorted(
            (int.from_bytes(hashlib.blake2b(f"{s}/{p}".encode(), digest_size=8).digest()) % self.slots, s)
            for s in range(self.shards)
            for p in range(self.points)
        )
        places = np.array([place for place, _ in owned])
        walks = np.zeros((len(owned), self.shards), dtype=np.int64)
        for arc in range(len(owned)):
            seen = dict.fromkeys(owned[(arc + k) % len(owned)][1] for k in range(len(owned)))
            walks[arc] = list(seen)
        return np.searchsorted(places, np.arange(self.slots)) % len(owned), walks


def settle(counts: np.ndarray, ring: Ring) -> pd.DataFrame:
    """Where each slot's rows go: rows ``first`` to ``first + rows - 1`` of ``ring_slot`` to
    ``shard``, from its place ``place`` on.

    In round r every slot offers its remaining rows to the r-th shard of its walk, which
    takes them in ring order while it has room.
    """
    arcs, walks = ring.walks()
    left, taken = counts.astype(np.int64), np.zeros(len(counts), dtype=np.int64)
    room = ring.capacities(int(left.sum()))
    filled = np.zeros(ring.shards, dtype=np.int64)
    parts = []
    for turn in range(ring.shards):
        target = walks[arcs, turn]
        for shard in range(ring.shards):
            slots = np.flatnonzero((target == shard) & (left > 0))
            if not len(slots) or room[shard] == filled[shard]:
                continue
            before = np.cumsum(left[slots]) - left[slots]
            rows = np.clip(room[shard] - filled[shard] - before, 0, left[slots])
            slots, rows, before = slots[rows > 0], rows[rows > 0], before[rows > 0]
            parts.append(
                pd.DataFrame(
                    {
                        "ring_slot": slots,
                        "first": taken[slots],
                        "rows": rows,
                        "shard": shard,
                        "place": filled[shard] + before,
                    }
                )
            )
            filled[shard] += rows.sum()
            taken[slots] += rows
            left[slots] -= rows
    empty = pd.DataFrame({c: np.zeros(0, np.int64) for c in ("ring_slot", "first", "rows", "shard", "place")})
    return pd.concat(parts, ignore_index=True) if parts else empty


def assigned(rows: DataFrame, keys: list[str], ring: Ring) -> DataFrame:
    """The key columns of every row with ``shard`` and ``slot``, its place there from 0.

    ``keys`` together decide a row's slot on the ring. Take enough of them that no value
    is shared by very many different rows.
    """
    ship_package(rows.sparkSession)
    slot = F.pmod(F.xxhash64(*keys), F.lit(ring.slots)).alias("ring_slot")
    distinct = rows.select(slot, *keys).groupBy("ring_slot", *keys).agg(F.count(F.lit(1)).alias("copies"))
    in_slot = Window.partitionBy("ring_slot").orderBy(*keys)
    # One row per slot at most, whatever the data; they are all that one task sees.
    counts = distinct.groupBy("ring_slot").agg(F.sum("copies").alias("slot_rows"))

    def all_slots(found: pd.DataFrame) -> pd.DataFrame:
        per_slot = np.zeros(ring.slots, dtype=np.int64)
        per_slot[found["ring_slot"].to_numpy()] = found["slot_rows"].to_numpy()
        return settle(per_slot, ring)

    schema = "ring_slot long, first long, rows long, shard long, place long"
    targets = counts.groupBy().applyInPandas(all_slots, schema)
    copy_before = F.coalesce(
        F.sum("copies").over(in_slot.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    runs = F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("copies") - 1) / RUN))
    copies = F.sequence(F.col("run") * RUN, F.least(F.col("copies"), (F.col("run") + 1) * RUN) - 1)
    numbered = (
        distinct.withColumn("before", copy_before)
        .withColumn("run", F.explode(runs))
        .withColumn("copy", F.explode(copies))
        .withColumn("rank", F.col("before") + F.col("copy"))
    )
    # At most a few rows for each slot and shard: bounded by the ring, not by the data.
    return (
        numbered.join(F.broadcast(targets), "ring_slot")
        .where((F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("first") + F.col("rows")))
        .select(
            *keys,
            F.col("shard").cast("int").alias("shard"),
            (F.col("place") + F.col("rank") - F.col("first")).alias("slot"),
        )
    )


def measured(docs: DataFrame) -> DataFrame:
    """(doc_id, size, text_crc32) of every document."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        "doc_id",
        (F.octet_length(text) + 8).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
