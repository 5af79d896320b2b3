"""Passages that stand more than once, found by anchors at difference-cover positions.

A window is a run of ``length`` words. Of the words of a document only those whose number
modulo 21 is in a difference cover begin an anchor, a run of 15 words: about one in four.
For any two places in two texts there is a shift below 21 after which both are in the
cover, so two equal windows of 35 words or more share an anchor at the same distance from
their begin. The work has three steps, and each hashes again what it needs:

1. anchors are counted, and those that stand once are done with;
2. around each anchor found again, the windows that hold it are hashed and counted;
   these extend the match to the full length, and are exact up to 64-bit hashes of words;
3. words covered by a window found again are cut.

Texts are dealt into chunks of a few megabytes by a hash of id, text and input partition. All that is sent
besides is (hash, chunk, how often): equal hashes of a chunk are one row, so a passage in
a third of all documents is one row for each chunk. No document meets another one.

Defined results for odd input: a null text has no words and stays null; a text with fewer
words than a window loses none; copies all lose what they share, none is left as the
first; equal rows count as places of their own, whatever their ids. Other columns pass
through, and an empty table gives an empty table.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chorale.llm.words import SPACED, Words, utf8_parts, windows_at, words_of
from chorale.session import ship_package

LENGTH = 35
CHUNK_BYTES = 4 << 20
# A perfect difference set. Every number below 21 is a difference of two of
# its elements modulo 21.
PERIOD, COVER = 21, [0, 1, 4, 14, 16]
_IN_COVER = np.isin(np.arange(PERIOD), COVER)


def text_bytes(docs: DataFrame) -> int:
    """UTF-8 bytes of all texts, for sizing the chunks."""
    return docs.agg(F.sum(F.octet_length("text").cast("bigint"))).first()[0] or 0


def _inside(words: Words, begin: np.ndarray, length: int) -> np.ndarray:
    """Which runs of ``length`` words lie in one text."""
    return begin + length <= words.bounds[words.text[begin] + 1]


def anchors(words: Words, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and first words of the anchors at cover positions, from each text's begin on."""
    at = np.arange(len(words))
    at = at[_IN_COVER[(at - words.bounds[words.text]) % PERIOD]]
    at = at[_inside(words, at, length)]
    return windows_at(words.hashes, at, length), at


def candidate_windows(words: Words, found: np.ndarray, length: int) -> np.ndarray:
    """First words of the windows that hold one of the anchors at ``found`` whole and aligned."""
    edges = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(edges, np.maximum(found - (PERIOD - 1), words.bounds[words.text[found]]), 1)
    np.add.at(edges, found + 1, -1)
    at = np.flatnonzero(np.cumsum(edges[:-1]) > 0)
    return at[_inside(words, at, length)]


def _counted(chunk: int, hashes: np.ndarray) -> pa.Table:
    distinct, n = np.unique(hashes, return_counts=True)
    return pa.table(
        {
            "hash": distinct.view(np.int64),
            "chunk": np.full(len(distinct), chunk, dtype=np.int64),
            # More than once is all that matters.
            "n": np.minimum(n, 2).astype(np.int32),
        }
    )


def _found_again(counted: DataFrame) -> DataFrame:
    """(chunk, hash) of the hashes that stand more than once; a hash has one row per chunk at most."""
    everywhere = F.sum("n").over(Window.partitionBy("hash"))
    return counted.withColumn("everywhere", everywhere).where("everywhere > 1").select("chunk", "hash")


def _known(hashes: np.ndarray, known: pa.Table) -> np.ndarray:
    keys = np.sort(known["hash"].to_numpy().view(np.uint64))
    if not len(keys):
        return np.zeros(len(hashes), dtype=bool)
    return keys[np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)] == hashes


def _texts(rows: pa.Table) -> pa.Array:
    return pa.chunked_array(rows["text"].chunks, rows.schema.field("text").type).combine_chunks()


def _cut(texts: pa.Array, words: Words, gone: np.ndarray) -> list[bytes | None]:
    """The texts without the words that are ``gone`` and the gaps after them."""
    data, offsets = utf8_parts(texts)
    out: list[bytes | None] = []
    for k, valid in enumerate(texts.is_valid().to_pylist()):
        a, b = words.bounds[k], words.bounds[k + 1]
        text = data[offsets[k] : offsets[k + 1]]
        if not valid:
            out.append(None)
        elif not gone[a:b].any():
            out.append(text.tobytes())
        else:
            edge = np.flatnonzero(np.diff(np.concatenate([[0], gone[a:b].astype(np.int8), [0]])))
            begins, ends = edge[::2], edge[1::2]
            starts = np.append(words.starts[a:b], len(text))
            pieces, at = [], 0
            for begin, end in zip(begins, ends, strict=True):
                pieces.append(text[at : starts[begin]].tobytes())
                at = starts[end] if end < b - a else words.ends[b - 1]
            out.append(b"".join([*pieces, text[at:].tobytes()]))
    return out


def _dealt(docs: DataFrame, key: str, n_chunks: int) -> DataFrame:
    """``docs`` with ``__chunk``. Rows equal in id and text differ in the part of the input that
    they are read from, which is the same when a task is repeated; so the copies that meet in a
    chunk are no more than one such part holds."""
    place = F.xxhash64(key, "text", F.spark_partition_id())
    return docs.withColumn("__chunk", F.pmod(place, F.lit(n_chunks)))


def deduplicated(
    docs: DataFrame, length: int = LENGTH, chunk_bytes: int = CHUNK_BYTES, key: str = "doc_id"
) -> DataFrame:
    """``docs`` with what is left of each text, and ``n_words`` and ``n_removed``.

    Reads the texts' total size first, to know into how many chunks to deal them. The
    dealt texts are shuffled once; the later steps read the same shuffle files again.
    """
    if length < PERIOD:
        raise ValueError(f"windows must have {PERIOD} words or more")
    ship_package(docs.sparkSession)
    anchor = length - PERIOD + 1
    n_chunks = max(1, math.ceil(text_bytes(docs) / chunk_bytes))
    docs = docs.drop("n_words", "n_removed")
    names = docs.columns
    dealt = _dealt(docs, key, n_chunks)
    counted = "hash long, chunk long, n int"

    def count_anchors(rows: pa.Table) -> pa.Table:
        words = words_of(_texts(rows), SPACED, lower=False)
        return _counted(rows["__chunk"][0].as_py(), anchors(words, anchor)[0])

    def count_windows(rows: pa.Table, known: pa.Table) -> pa.Table:
        if not rows.num_rows or not known.num_rows:
            return _counted(0, np.zeros(0, np.uint64))
        words = words_of(_texts(rows), SPACED, lower=False)
        hashes, at = anchors(words, anchor)
        begin = candidate_windows(words, at[_known(hashes, known)], length)
        return _counted(rows["__chunk"][0].as_py(), windows_at(words.hashes, begin, length))

    added = T.StructType.fromDDL("n_words long, n_removed long")
    schema = T.StructType([*docs.schema.fields, *added.fields])

    def cut(rows: pa.Table, known: pa.Table) -> pa.Table:
        texts = _texts(rows)
        words = words_of(texts, SPACED, lower=False)
        edges = np.zeros(len(words) + 1, dtype=np.int64)
        if known.num_rows:
            at = np.arange(len(words))
            at = at[_inside(words, at, length)]
            begin = at[_known(windows_at(words.hashes, at, length), known)]
            np.add.at(edges, begin, 1)
            np.add.at(edges, begin + length, -1)
        gone = np.cumsum(edges[:-1]) > 0
        total = np.concatenate([[0], np.cumsum(gone)])
        left = {c: rows[c] for c in names}
        left["text"] = pa.array(_cut(texts, words, gone), pa.binary()).cast(pa.string())
        left["n_words"] = np.diff(words.bounds).astype(np.int64)
        left["n_removed"] = total[words.bounds[1:]] - total[words.bounds[:-1]]
        return pa.table(left)

    # A text's chunk never changes, so the same shuffle of texts serves all three steps.
    by_chunk = dealt.groupBy("__chunk")
    again = _found_again(by_chunk.applyInArrow(count_anchors, counted))
    windows = by_chunk.cogroup(again.groupBy("chunk")).applyInArrow(count_windows, counted)
    again = _found_again(windows)
    return by_chunk.cogroup(again.groupBy("chunk")).applyInArrow(cut, schema)


def report(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256): the digest is of the words left, joined by blanks."""
    kept = F.expr(r"array_join(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+', 0), ' ')")
    return deduplicated(docs.select("doc_id", "text")).select(
        "doc_id", "n_words", "n_removed", F.sha2(kept, 256).alias("kept_sha256")
    )
