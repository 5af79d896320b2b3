"""Near copies by DartMinHash signatures and banding, each link checked exactly.

A text is a weighted set: its runs of five lower-cased words, weighted by how often they
stand in it. Darts are thrown by hash at the plane of weight and rank of every element,
about one for each unit of area, the same for every text that has the element with that
weight. The darts below a text's weights and below a rank that about ``k ln k + 2k`` of
them reach are dealt to ``k`` coordinates by another hash, and each coordinate keeps its
earliest dart; a coordinate that got none looks at higher ranks. Two texts agree in a
coordinate with a chance of their weighted Jaccard similarity, at a cost of the text's
length and ``k log k``, not their product.

Coordinates are joined in bands. At a similarity of 0.8 all of a band's 6 agree with a
chance of 0.26, so the chance that none of 40 bands does is 5 in a million. Equal texts
are one node. In each bucket all nodes are compared with one of them, the hub, which
settles a group of copies without its pairs. Only where a bucket then still holds nodes
of several components are nodes of different ones looked at: sketches of 1024 bits tell
which of them can be similar enough, and those are compared too. So no link that a bucket
holds is lost (but for one in a hundred thousand right at the threshold), and texts known
to be in one component are never paired.

Defined results for odd input: a text of fewer than five words is one run of them all;
texts without words (null and empty ones too) are near copies of equal texts only; rows
equal in id and text are the same document; a null id is an id, after all others.
Components are called by their least id. Other columns are left out; an empty table
gives an empty table.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chorale.llm.components import components
from chorale.llm.words import PLAIN, Words, mixed, slices, windows_at, words_of
from chorale.session import Workspace, ship_package

SHINGLE = 5
# Odd numbers that keep the hashes of weights, ranks, darts and bands apart.
_BY_WEIGHT, _BY_RANK, _BY_DART, _BY_COORDINATE, _BY_BAND = (
    np.uint64(x)
    for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63)
)
# Below these shares of 2^64 a hash stands for 0, 1, 2 ... darts: Poisson with mean 1.
_DARTS = np.array(
    [int(sum(math.exp(-1) / math.factorial(j) for j in range(i + 1)) * 2**64) for i in range(12)],
    dtype=np.uint64,
)
_UNIT = 2.0**-53
# Cells looked at at once, which bounds a task's memory beside one text's words.
CELLS = 1 << 20


@dataclass(frozen=True)
class Banding:
    bands: int = 40
    rows: int = 6
    threshold: float = 0.8
    sketch_bits: int = 1024

    @property
    def coordinates(self) -> int:
        return self.bands * self.rows


def shingles(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of all runs of five words, or of all words of a shorter text."""
    n = len(words)
    sizes = np.diff(words.bounds)
    at = np.arange(n)
    at = at[at + SHINGLE <= words.bounds[words.text + 1]]
    hashes, text = windows_at(words.hashes, at, SHINGLE), words.text[at]
    for size in range(1, SHINGLE):
        short = np.flatnonzero(sizes == size)
        hashes = np.concatenate([hashes, windows_at(words.hashes, words.bounds[short], size)])
        text = np.concatenate([text, short])
    return text, hashes


def _weighted(text: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (text, hash) and how often each is there, ordered by text."""
    order = np.lexsort((hashes, text))
    text, hashes = text[order], hashes[order]
    new = np.ones(len(text), dtype=bool)
    new[1:] = (text[1:] != text[:-1]) | (hashes[1:] != hashes[:-1])
    first = np.flatnonzero(new)
    return text[first], hashes[first], np.diff(np.append(first, len(text)))


def _expand(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each index as often as counted, and the number of each within its index."""
    index = np.repeat(np.arange(len(counts)), counts)
    return index, np.arange(len(index)) - np.repeat(np.cumsum(counts) - counts, counts)


def _throw(
    element: np.ndarray, weight: np.ndarray, low: np.ndarray, high: np.ndarray
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(place of the element, rank, dart) of the darts with a rank from ``low`` to ``high``."""
    floor, ranks = np.floor(low).astype(np.int64), None
    ranks = np.ceil(high).astype(np.int64) - floor
    cells = weight * ranks
    ends = np.cumsum(cells)
    begin = 0
    while begin < len(element):
        done = ends[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(ends, done + CELLS, "right")))
        for first in range(0, int(cells[begin]) if end == begin + 1 else 1, CELLS):
            if end == begin + 1:
                number = np.arange(first, min(first + CELLS, int(cells[begin])))
                index = np.full(len(number), begin)
            else:
                index, number = _expand(cells[begin:end])
                index += begin
            rank = floor[index] + number % ranks[index]
            level = (number // ranks[index]).astype(np.uint64)
            cell = mixed(element[index] + level * _BY_WEIGHT + rank.astype(np.uint64) * _BY_RANK)
            darts = np.zeros(len(cell), dtype=np.int64)
            for bound in _DARTS:
                darts += cell >= bound
            of_cell, number = _expand(darts)
            dart = mixed(cell[of_cell] + (number + 1).astype(np.uint64) * _BY_DART)
            height = rank[of_cell] + (dart >> np.uint64(11)) * _UNIT
            index = index[of_cell]
            hit = (height >= low[index]) & (height < high[index])
            yield index[hit], height[hit], dart[hit]
        begin = end


def signatures(text: np.ndarray, hashes: np.ndarray, n_texts: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The earliest dart in each of ``k`` coordinates, and which texts have any element."""
    text, element, weight = _weighted(text, hashes)
    total = np.bincount(text, weights=weight, minlength=n_texts)
    rank = (k * math.log(k) + 2 * k) / np.maximum(total, 1)
    best = np.full(n_texts * k, np.inf)
    value = np.zeros(n_texts * k, dtype=np.uint64)
    held = total > 0
    open_text, turn = held.copy(), 0
    while open_text.any():
        use = np.flatnonzero(open_text[text])
        owner = text[use]
        low, high = rank[owner] * turn, rank[owner] * (turn + 1)
        # What a coordinate got in an earlier turn is of a lower rank and stays.
        for index, height, dart in _throw(element[use], weight[use], low, high):
            at = owner[index] * k + (mixed(dart ^ _BY_COORDINATE) % np.uint64(k)).astype(np.int64)
            np.minimum.at(best, at, height)
            won = best[at] == height
            value[at[won]] = dart[won]
        open_text = held & np.isinf(best).reshape(n_texts, k).any(axis=1)
        turn += 1
    return value.reshape(n_texts, k), held


def band_hashes(values: np.ndarray, banding: Banding) -> np.ndarray:
    """One hash for each text and band."""
    n = len(values)
    parts = values.reshape(n, banding.bands, banding.rows)
    out = np.tile(np.arange(1, banding.bands + 1, dtype=np.uint64) * _BY_BAND, (n, 1))
    for row in range(banding.rows):
        out = mixed(out + parts[:, :, row])
    return out


def _signed(docs: DataFrame, banding: Banding) -> DataFrame:
    """(node, bands) for each row; no bands where the text has no words."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                words = words_of(part.column("text"), PLAIN, lower=True)
                values, held = signatures(*shingles(words), part.num_rows, banding.coordinates)
                bands = band_hashes(values, banding).view(np.int64)
                offsets = np.concatenate([[0], np.cumsum(np.where(held, banding.bands, 0))])
                yield pa.record_batch(
                    [
                        part.column("doc_id"),
                        part.column("node"),
                        pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(bands[held].reshape(-1))),
                    ],
                    names=["doc_id", "node", "bands"],
                )

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "node", "text").mapInArrow(
        sign, f"doc_id {id_type}, node binary, bands array<long>"
    )


def _similarities(left: pa.Array, right: pa.Array) -> np.ndarray:
    """Weighted Jaccard similarity of the texts at the same places."""
    n = len(left)
    keys, sides = [], []
    for side, texts in enumerate((left, right)):
        text, hashes = shingles(words_of(texts, PLAIN, lower=True))
        keys.append(np.column_stack([text.astype(np.uint64), hashes]))
        sides.append(np.full(len(text), side))
    table = np.concatenate(keys)
    order = np.lexsort((table[:, 1], table[:, 0]))
    table, side = table[order], np.concatenate(sides)[order]
    new = np.ones(len(table), dtype=bool)
    new[1:] = (table[1:] != table[:-1]).any(axis=1)
    group = np.cumsum(new) - 1
    second = np.bincount(group, weights=side, minlength=int(new.sum()))
    first = np.bincount(group, minlength=int(new.sum())) - second
    pair = table[new, 0].astype(np.int64)
    common = np.bincount(pair, weights=np.minimum(first, second), minlength=n)
    union = np.bincount(pair, weights=np.maximum(first, second), minlength=n)
    return common / np.maximum(union, 1)


def _links(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) whose texts are similar enough."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text_a", 1 << 20):
                alike = _similarities(part.column("text_a"), part.column("text_b")) >= threshold - 1e-12
                rows = part.filter(pa.array(alike))
                yield pa.record_batch([rows.column("a"), rows.column("b")], names=["a", "b"])

    one = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    other = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    both = pairs.join(one, "a").join(other, "b").select("a", "b", "text_a", "text_b")
    return both.mapInArrow(compare, "a binary, b binary")


def _with_hubs(shared: DataFrame) -> DataFrame:
    """(bucket, node, hub): the hub is the node that meets most others in all its buckets.

    Of a group of copies that is the one closest to the others, often their common source.
    """
    met = shared.groupBy("node").agg(F.sum("n").alias("met"))
    ranked = shared.join(met, "node").select("bucket", "node", "met")
    hubs = ranked.groupBy("bucket").agg(F.max(F.struct("met", "node")).alias("best"))
    return ranked.join(hubs, "bucket").select("bucket", "node", F.col("best.node").alias("hub"))


def _sketched(texts: DataFrame, bits: int) -> DataFrame:
    """(node, s0, s1, ...): one bit of each of ``bits`` coordinates, 64 to a number."""
    names = [f"s{k}" for k in range(bits // 64)]

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 1 << 18):
                words = words_of(part.column("text"), PLAIN, lower=True)
                values, _ = signatures(*shingles(words), part.num_rows, bits)
                packed = np.packbits((values >> np.uint64(7) & np.uint64(1)).astype(np.uint8), axis=1)
                numbers = np.ascontiguousarray(packed).view(np.int64)
                columns = [pa.array(np.ascontiguousarray(numbers[:, k])) for k in range(len(names))]
                yield pa.record_batch([part.column("node"), *columns], names=["node", *names])

    return texts.mapInArrow(sketch, "node binary, " + ", ".join(f"{n} long" for n in names))


def _across(open_rows: DataFrame, nodes: DataFrame, texts: DataFrame, banding: Banding) -> DataFrame:
    """Pairs (a, b) of different components in a bucket that may be links and weren't compared.

    Both conditions belong to the join, so that pairs that fail make no rows: a pair is
    taken in the first band it shares only, and its sketches must differ in no more bits
    than those of similar texts do (4.2 standard deviations off the mean at the threshold).
    """
    bits = banding.sketch_bits
    least = banding.threshold - 4.2 * math.sqrt(1 - banding.threshold**2) / math.sqrt(bits)
    own = open_rows.select("node").distinct()
    # 31 bits of each band's hash are enough to tell bands apart within one pair.
    low_bits = F.transform("bands", lambda x: x.bitwiseAND(F.lit(0x7FFFFFFF)).cast("int"))
    facts = (
        nodes.join(own, "node", "left_semi")
        .select("node", low_bits.alias("bands"))
        .join(_sketched(texts.join(own, "node", "left_semi"), bits), "node")
    )
    rows = open_rows.join(facts, "node").where("node <> hub").drop("hub")
    one = rows.select("bucket", *[F.col(c).alias(f"a_{c}") for c in rows.columns if c != "bucket"])
    other = rows.select("bucket", *[F.col(c).alias(f"b_{c}") for c in rows.columns if c != "bucket"])
    differ = " + ".join(f"bit_count(a_s{k} ^ b_s{k})" for k in range(bits // 64))
    alike = f"({differ}) <= {math.floor((1 - least) / 2 * bits)}"
    here = "CAST(o.bucket & 2147483647 AS INT)"
    first = f"""array_position(a_bands, {here}) = array_position(zip_with(a_bands, b_bands, (x, y) -> x = y), true)"""
    joined = one.alias("o").join(
        other.alias("t"),
        F.expr(f"o.bucket = t.bucket AND a_component < b_component AND {alike} AND {first}"),
    )
    return joined.select(F.col("a_node").alias("a"), F.col("b_node").alias("b")).distinct()


def with_node(docs: DataFrame) -> DataFrame:
    """``docs`` with ``node``, a digest that stands for the text."""
    return docs.withColumn("node", F.unhex(F.md5(F.coalesce("text", F.lit("")))))


def classes(docs: DataFrame, banding: Banding = Banding()) -> DataFrame:
    """(doc_id, node, class_id, kept): each row's class, and whether its class keeps it.

    ``docs`` has ``doc_id``, ``text`` and ``node``. It is read twice: for signatures, and
    for the texts of those that share a bucket. All tables written on the way are deleted
    again, but the one of classes, which the result reads.
    """
    ship_package(docs.sparkSession)
    work = Workspace(docs.sparkSession, "near-duplicates")
    signed = _signed(docs, banding)
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id")
    nodes = work.keep(
        signed.groupBy("node").agg(F.min(order).alias("first"), F.first("bands").alias("bands")), "nodes"
    )
    rows = nodes.select("node", F.explode("bands").alias("bucket"))
    sizes = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    counted = work.keep(rows.join(sizes, "bucket"), "counted")
    shared = work.keep(_with_hubs(counted), "shared")
    work.drop(counted)
    members = shared.select("node").distinct()
    wanted = nodes.join(members, "node", "left_semi").select("node", "first.doc_id").alias("w")
    candidates = docs.select("doc_id", "node", "text").alias("d")
    same_id = F.col("d.doc_id").eqNullSafe(F.col("w.doc_id"))
    texts = work.keep(
        candidates.join(wanted, (F.col("d.node") == F.col("w.node")) & same_id)
        .select("d.node", "d.text")
        .dropDuplicates(["node"]),
        "texts",
    )
    pairs = shared.where("node <> hub").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct()
    stars = components(_links(pairs, texts, banding.threshold), "a", "b", work)
    # Buckets that hold several components yet: compare across them what no hub has settled.
    placed = shared.join(stars, "node", "left").withColumn(
        "component", F.coalesce("component", F.col("node"))
    )
    several = (
        placed.groupBy("bucket")
        .agg(F.min("component").alias("low"), F.max("component").alias("high"))
        .where("low <> high")
        .select("bucket")
    )
    open_rows = work.keep(
        placed.join(several, "bucket", "left_semi").select("bucket", "hub", "node", "component"), "open"
    )
    across = _links(_across(open_rows, nodes, texts, banding), texts, banding.threshold)
    # The stars stand for the links they came from.
    tied = stars.select(F.col("node").alias("a"), F.col("component").alias("b"))
    named = components(tied.unionByName(across), "a", "b", work)
    label = nodes.select("node", "first").join(named, "node", "left")
    label = label.withColumn("component", F.coalesce("component", F.col("node")))
    least = label.groupBy("component").agg(F.min(F.struct("first", "node")).alias("kept"))
    by_node = work.keep(
        label.join(least, "component").select(
            "node", F.col("kept.first.doc_id").alias("class_id"), F.col("kept.node").alias("kept_node")
        ),
        "classes",
    )
    work.drop(nodes, shared, texts, stars, open_rows, named)
    kept = (F.col("node") == F.col("kept_node")) & F.col("doc_id").eqNullSafe(F.col("class_id"))
    ids = docs.select("doc_id", "node")
    return ids.join(by_node, "node").select("doc_id", "node", "class_id", kept.alias("kept"))


def deduplicated(docs: DataFrame, banding: Banding = Banding()) -> DataFrame:
    """One document of each class, with all its columns."""
    keyed = with_node(docs.select("doc_id", "text"))
    kept = classes(keyed, banding).where("kept")
    # Plain equality on columns without nulls, the same for join and duplicates, so that
    # texts are shuffled once.
    keys = {
        "__node": F.unhex(F.md5(F.coalesce("text", F.lit("")))),
        "__id": F.coalesce(F.col("doc_id"), F.lit(0)),
        "__no_id": F.col("doc_id").isNull(),
    }
    one = kept.select(F.col("node").alias("__node"), *[v.alias(k) for k, v in keys.items() if k != "__node"])
    found = docs.withColumns(keys).join(one.distinct(), list(keys)).dropDuplicates(list(keys))
    return found.select(docs.columns)
