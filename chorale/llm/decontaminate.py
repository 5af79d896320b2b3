"""Benchmark passages in documents: a prefix-filtered set join, verified word by word.

An item's windows are its runs of ``length`` words; an item with fewer words is one
window. A window occurs in a document if its words stand there in a row, so all of its
shingles (runs of three words, or all of a shorter window) must be there: at containment
1 a window's prefix in rarity order is its rarest shingle. Rarity is counted over all
documents. Places of documents that may hold a prefix are joined with the shapes of its
windows, which say where a window would begin and end: those that leave the text go by
position and length, and the words of the others are joined with the windows' words.

Items, windows, rarities and places are DataFrames; neither the driver nor a task holds
the benchmark. What goes to all workers is a bit filter of ``filter_longs`` numbers, 8 MB
at any size of the benchmark. It only spares rows: one that is too small for the
benchmark lets more places through to the join, and the result is the same. Equal items
and equal texts are looked at once, places of equal texts are put together before they
are joined, and a shingle has one row of shapes, so hot texts and hot shingles multiply
nothing. Documents are read and never shuffled for the search; ``marked`` and
``without_contaminated`` join them with what was found by a digest of the text.

Defined results for odd input: a null text has no words, in documents as in items; an
item without words occurs nowhere; equal items all count by their ids, a null id as an
empty one; equal documents get equal results; an empty benchmark finds nothing. Columns
of the result replace those of the same name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chorale.llm.words import PLAIN, Words, slices, window_hashes, words_of
from chorale.session import Workspace, ship_package

LENGTH = 10
SHINGLE = 3
FILTER_LONGS = 1 << 20
# Places that go out in one batch.
STEP = 1 << 16
# The same words as ``PLAIN`` finds, for counting them; A-Z count as letters.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def _runs(first: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers of all runs ``first, first + 1, ...`` of the given lengths, one after another."""
    ends = np.cumsum(lengths)
    return np.repeat(first - ends + lengths, lengths) + np.arange(ends[-1] if len(ends) else 0)


def _lists(values: np.ndarray, first: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """For each run the values at its numbers."""
    edges = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    flat = values[_runs(first, lengths)].view(np.int64)
    return pa.ListArray.from_arrays(pa.array(edges), pa.array(flat))


def shingled(items: DataFrame, length: int) -> DataFrame:
    """(item, place, shingle, words) of all shingles of distinct texts; ``item`` is a digest.

    ``words`` are those of the window that begins at ``place``, none where no window does.
    """
    ship_package(items.sparkSession)
    top = min(SHINGLE, length)

    def shingle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", limit=1 << 20):
                words = words_of(part.column("text"), PLAIN, lower=True)
                many = np.diff(words.bounds)
                for size in range(1, top + 1):
                    hashes, at = window_hashes(words, size)
                    n = many[words.text[at]]
                    own = (n == size) | (n >= size if size == top else False)
                    hashes, at, n = hashes[own], at[own], n[own]
                    place = at - words.bounds[words.text[at]]
                    wide = np.minimum(n, length)
                    yield pa.record_batch(
                        [
                            part.column("item").take(pa.array(words.text[at])),
                            pa.array(place.astype(np.int64)),
                            pa.array(np.full(len(at), size, np.int32)),
                            pa.array(hashes.view(np.int64)),
                            _lists(words.hashes, at, np.where(place <= n - wide, wide, 0)),
                        ],
                        names=["item", "place", "size", "shingle", "words"],
                    )

    texts = items.where(F.col("text").isNotNull()).select(F.md5("text").alias("item"), "text")
    texts = texts.groupBy("item").agg(F.first("text").alias("text"))
    return texts.mapInArrow(
        shingle, "item string, place long, size int, shingle long, words array<long>"
    )


@dataclass
class Filter:
    """Bits of shingles, in ``bits``; which sizes of shingles there are, as bits too."""

    bits: np.ndarray
    sizes: int

    def places(self, words: Words) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(shingle, number of its first word) of all shingles that may be among those given."""
        for size in range(1, self.sizes.bit_length()):
            if self.sizes >> size & 1:
                hashes, at = window_hashes(words, size)
                row = self.bits[(hashes >> np.uint64(6)) % np.uint64(len(self.bits))]
                held = np.flatnonzero((row >> (hashes & np.uint64(63))) & np.uint64(1))
                yield hashes[held], at[held]


def filter_of(shingles: DataFrame, filter_longs: int) -> Filter:
    """A filter of (size, shingle); no more than ``filter_longs`` rows come to the driver."""
    rows = (
        shingles.groupBy(F.expr(f"shiftrightunsigned(shingle, 6) % {filter_longs}").alias("at"))
        .agg(
            F.expr("bit_or(shiftleft(1L, cast(shingle & 63 AS int)))").alias("bits"),
            F.expr("bit_or(shiftleft(1, size))").alias("sizes"),
        )
        .toArrow()
    )
    bits = np.zeros(filter_longs, dtype=np.uint64)
    bits[rows["at"].to_numpy()] = rows["bits"].to_numpy().view(np.uint64)
    return Filter(bits, int(np.bitwise_or.reduce(rows["sizes"].to_numpy(), initial=0)))


def counted(docs: DataFrame, wanted: Filter) -> DataFrame:
    """(shingle, n): how often shingles that pass the filter stand in all documents."""
    known = docs.sparkSession.sparkContext.broadcast(wanted)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                words = words_of(part.column("text"), PLAIN, lower=True)
                for hashes, _ in known.value.places(words):
                    held, n = np.unique(hashes, return_counts=True)
                    yield pa.record_batch(
                        [pa.array(held.view(np.int64)), pa.array(n.astype(np.int64))],
                        names=["shingle", "n"],
                    )

    found = docs.select("text").mapInArrow(count, "shingle long, n long")
    return found.groupBy("shingle").agg(F.sum("n").alias("n"))


def prefixed(shingles: DataFrame, counts: DataFrame, length: int) -> DataFrame:
    """(item, words, size, shingle, offset): each window that may occur, and its prefix.

    A window whose rarest shingle stands in no document occurs nowhere and goes.
    """
    inside = (
        Window.partitionBy("item").orderBy("place").rowsBetween(0, length - min(SHINGLE, length))
    )
    known = shingles.join(counts, "shingle", "left")
    rarity = F.struct(F.coalesce("n", F.lit(0)).alias("n"), "shingle", "place")
    return (
        known.withColumn("rarest", F.min(rarity).over(inside))
        .where((F.size("words") > 0) & (F.col("rarest.n") > 0))
        .select(
            "item",
            "words",
            "size",
            F.col("rarest.shingle").alias("shingle"),
            (F.col("rarest.place") - F.col("place")).cast("int").alias("offset"),
        )
    )


def places(docs: DataFrame, wanted: Filter, length: int) -> DataFrame:
    """(digest, place, shingle, lead, context): where distinct texts may hold a prefix.

    The context are the words that a window with the shingle may have, ``lead`` of them
    before the place.
    """
    known = docs.sparkSession.sparkContext.broadcast(wanted)

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                words = words_of(part.column("text"), PLAIN, lower=True)
                for hashes, at in known.value.places(words):
                    for begin in range(0, len(at), STEP):
                        here = at[begin : begin + STEP]
                        text = words.text[here]
                        low = np.maximum(here - length + 1, words.bounds[text])
                        high = np.minimum(here + length, words.bounds[text + 1])
                        yield pa.record_batch(
                            [
                                part.column("digest").take(pa.array(text)),
                                pa.array((here - words.bounds[text]).astype(np.int64)),
                                pa.array(hashes[begin : begin + STEP].view(np.int64)),
                                pa.array((here - low).astype(np.int32)),
                                _lists(words.hashes, low, high - low),
                            ],
                            names=["digest", "place", "shingle", "lead", "context"],
                        )

    texts = docs.select(F.md5("text").alias("digest"), "text")
    schema = "digest string, place long, shingle long, lead int, context array<long>"
    return texts.mapInArrow(look, schema).distinct()


def occurrences(near: DataFrame, windows: DataFrame) -> DataFrame:
    """(digest, start, length, window) of every place where a window occurs in a text."""
    window = F.xxhash64("words").alias("window")
    shapes = windows.groupBy("shingle").agg(
        F.collect_set(F.struct("offset", F.size("words").alias("length"))).alias("shapes")
    )
    tried = (
        near.join(shapes, "shingle")
        .select("digest", "place", "lead", "context", F.explode("shapes").alias("shape"))
        .select("*", "shape.*")
        .where("offset <= lead AND lead - offset + length <= size(context)")
        .select(
            "digest",
            (F.col("place") - F.col("offset")).alias("start"),
            "length",
            F.expr("slice(context, lead - offset + 1, length)").alias("words"),
        )
    )
    held = windows.select("words", window).distinct()
    return tried.join(held, "words").select("digest", "start", "length", "window")


def covered(hits: DataFrame) -> DataFrame:
    """(digest, n_hit): how many words of each text are inside occurrences."""
    before = Window.partitionBy("digest").orderBy("start", "length").rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("start") + F.col("length")
    reached = F.greatest("start", F.coalesce(F.max(end).over(before), F.lit(0)))
    new = hits.select("digest", F.greatest(end - reached, F.lit(0)).alias("new"))
    return new.groupBy("digest").agg(F.sum("new").alias("n_hit"))


def owners(hits: DataFrame, windows: DataFrame, items: DataFrame) -> DataFrame:
    """(digest, items): ids of the items with windows in each text, sorted."""
    held = windows.select(F.xxhash64("words").alias("window"), "item")
    ids = items.select(
        F.md5("text").alias("item"), F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("id")
    )
    return (
        hits.select("digest", "window")
        .distinct()
        .join(held, "window")
        .select("digest", "item")
        .distinct()
        .join(ids, "item")
        .groupBy("digest")
        .agg(F.sort_array(F.collect_set("id")).alias("items"))
    )


def found(
    docs: DataFrame, items: DataFrame, length: int = LENGTH, filter_longs: int = FILTER_LONGS
) -> DataFrame:
    """(digest, n_hit, items) of the distinct texts that hold a window; a written table."""
    work = Workspace(docs.sparkSession, "decontaminate")
    shingles = work.keep(shingled(items.select("item_id", "text"), length), "shingles")
    counts = counted(docs, filter_of(shingles.select("size", "shingle"), filter_longs))
    windows = work.keep(prefixed(shingles, counts, length), "windows")
    near = places(docs, filter_of(windows.select("size", "shingle"), filter_longs), length)
    hits = work.keep(occurrences(near, windows), "hits")
    out = work.keep(covered(hits).join(owners(hits, windows, items), "digest"), "found")
    work.drop(shingles, windows, hits)
    return out


def _digest_and_count(text: Column) -> list[Column]:
    n_words = F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0))
    return [F.md5(text).alias("__digest"), n_words.cast("bigint").alias("n_words")]


def _with_found(rows: DataFrame, texts: DataFrame) -> DataFrame:
    """``rows`` with ``n_hit`` and ``items`` in place of ``__digest``."""
    return rows.join(texts, rows["__digest"] == texts["digest"], "left").select(
        *[rows[c] for c in rows.columns if c != "__digest"],
        F.coalesce(texts["n_hit"], F.lit(0)).alias("n_hit"),
        F.coalesce(texts["items"], F.array().cast("array<string>")).alias("items"),
    )


def marked(
    docs: DataFrame, items: DataFrame, length: int = LENGTH, filter_longs: int = FILTER_LONGS
) -> DataFrame:
    """``docs`` with ``n_words``, ``n_hit`` (words inside occurrences) and ``items`` (ids, sorted)."""
    texts = found(docs, items, length, filter_longs)
    docs = docs.drop("n_words", "n_hit", "items")
    return _with_found(docs.select("*", *_digest_and_count(docs["text"])), texts)


def report(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) of every document."""
    rows = docs.select("doc_id", *_digest_and_count(docs["text"]))
    return _with_found(rows, found(docs, items)).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def without_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents in which no window of any item occurs."""
    texts = found(docs, items)
    return docs.join(texts, F.md5(docs["text"]) == texts["digest"], "left_anti")
