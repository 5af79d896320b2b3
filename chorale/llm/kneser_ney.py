"""Interpolated modified Kneser-Ney model of word pairs: counting, model files, scores.

Counting is Spark's work. Tasks count the pairs of some millions of tokens at a time and
send them, packed, to shards by the pair's first word; first words so frequent that they
would fill a shard are spread over all shards by the second word as well. A shard's pairs
are summed and written as one sorted array of 64-bit hashes with one of counts. From the
same pass come, for each word, how many tokens and types follow it and how many different
words it follows, which is all that interpolation needs. Discounts come from the counts
of counts, each level with its own.

The model is a folder of such arrays. Workers map them into memory, so that a task holds
no more than the pages it looks at, and look up a batch's distinct keys in sorted order.
The folder must be a path that all machines have mounted under the same name; it is made
under ``spark.checkpoint.dir``. Files are written under another name and moved, so a task
that is run again does no harm.

Defined results for odd input: a null text is empty and has one token, its end; equal
rows are counted and scored one by one; a word never seen gets the share of one unknown
word; with nothing to learn from every token has probability 1. A null id counts as
empty text. Further columns are left out, and an empty table gives an empty table.
"""

from __future__ import annotations

import math
import os
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chorale.llm.words import SPACED, mixed, slices, words_of
from chorale.session import ensure_checkpoint_dir, scratch_path, ship_package

# What stands for a text's end and for the place before its first word.
END, BEGIN = np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)
_PAIR = np.uint64(0xA0761D6478BD642F)
SHARD_BYTES = 16 << 20
WORDS_PER_SHARD = 1 << 20
FLUSH_TOKENS = 2 << 20
SLICE_BYTES = 2 << 20
# Discounts where the counts of counts can't give any.
FALLBACK = (0.5, 1.0, 1.5)
# A count is kept in one byte; this one stands for those that need more, in a file of their own.
LARGE = 255
WORD_COLUMNS = ["n", "before", "after", "types", "once", "twice"]


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, word, word before) of every token, each text's end included."""
    words = words_of(texts, SPACED, lower=True)
    n = len(texts)
    token = np.empty(len(words) + n, dtype=np.uint64)
    token[np.arange(len(words)) + words.text] = words.hashes
    ends = words.bounds[1:] + np.arange(n)
    token[ends] = END
    before = np.roll(token, 1)
    begins = words.bounds[:-1] + np.arange(n)
    before[begins] = BEGIN
    return np.repeat(np.arange(n), np.diff(words.bounds) + 1), token, before


def pair_keys(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    return mixed(before * _PAIR + mixed(word))


def pair_shards(before: np.ndarray, word: np.ndarray, hot: np.ndarray, n: int) -> np.ndarray:
    """The shard of each pair: by its first word, or by both where that one is hot."""
    at = np.minimum(np.searchsorted(hot, before), len(hot) - 1)
    by = np.where(hot[at] == before, pair_keys(before, word), mixed(before))
    return (by % np.uint64(n)).astype(np.int64)


def _flushed(
    batches: Iterator[pa.RecordBatch], count: Callable[[np.ndarray, np.ndarray], pa.RecordBatch]
) -> Iterator[pa.RecordBatch]:
    """``count`` of (word, word before), called for some millions of tokens at a time."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    size = 0
    for batch in batches:
        for part in slices(batch, "text", SLICE_BYTES):
            _, word, before = tokens(part.column("text"))
            held.append((word, before))
            size += len(word)
            if size >= FLUSH_TOKENS:
                word, before = (np.concatenate(x) for x in zip(*held, strict=True))
                held, size = [], 0
                yield count(word, before)
    if held:
        yield count(*(np.concatenate(x) for x in zip(*held, strict=True)))


def count_words(docs: DataFrame) -> DataFrame:
    """(word, n) for every distinct token."""

    def count(word: np.ndarray, _: np.ndarray) -> pa.RecordBatch:
        distinct, n = np.unique(word, return_counts=True)
        return pa.record_batch([pa.array(distinct.view(np.int64)), pa.array(n)], names=["word", "n"])

    partial = docs.select("text").mapInArrow(lambda b: _flushed(b, count), "word long, n long")
    return partial.groupBy("word").agg(F.sum("n").alias("n"))


def _ordered(before: np.ndarray, word: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct pairs in the order of their first words, and the sums of ``n``."""
    order = np.lexsort((word, before))
    before, word, n = before[order], word[order], n[order]
    new = np.ones(len(word), dtype=bool)
    new[1:] = (before[1:] != before[:-1]) | (word[1:] != word[:-1])
    first = np.flatnonzero(new)
    sums = np.add.reduceat(n, first) if len(first) else n[:0]
    return before[first], word[first], sums


def count_pairs(docs: DataFrame, hot: np.ndarray, n_shards: int) -> DataFrame:
    """Packed counts: for some millions of tokens one row for each shard they have pairs in, and
    an empty row for every shard, so that each has files."""

    def count(word: np.ndarray, before: np.ndarray) -> pa.RecordBatch:
        before, word, n = _ordered(before, word, np.ones(len(word), dtype=np.int64))
        shard = pair_shards(before, word, hot, n_shards)
        order = np.argsort(shard, kind="stable")
        cuts = np.searchsorted(shard[order], np.arange(n_shards + 1))
        rows = []
        for k in np.flatnonzero(np.diff(cuts)).tolist():
            own = order[cuts[k] : cuts[k + 1]]
            firsts, runs = np.unique(before[own], return_counts=True)
            packed = (firsts, runs.astype(np.uint32), word[own], n[own].astype(np.uint32))
            rows.append((k, *(x.tobytes() for x in packed)))
        columns = list(zip(*rows, strict=True)) if rows else [()] * len(names)
        kinds = [pa.int64(), *[pa.binary()] * 4]
        return pa.record_batch([pa.array(x, t) for x, t in zip(columns, kinds, strict=True)], names=names)

    names = ["shard", "firsts", "runs", "words", "counts"]
    schema = "shard long, firsts binary, runs binary, words binary, counts binary"
    nothing = [F.lit(b"").alias(c) for c in names[1:]]
    every = docs.sparkSession.range(n_shards).select(F.col("id").alias("shard"), *nothing)
    return docs.select("text").mapInArrow(lambda b: _flushed(b, count), schema).unionByName(every)


def save(folder: str, name: str, values: np.ndarray) -> None:
    """Write an array so that its name never holds half of it."""
    path = os.path.join(folder, name)
    part = f"{path}.{uuid.uuid4().hex}"
    values.tofile(part)
    os.replace(part, path)


def _write_pairs(packed: DataFrame, folder: str) -> DataFrame:
    """Writes each shard's pairs; returns what they say about the words in them.

    (word, before, after, types, once, twice, thrice, four): ``before`` counts the
    different words that it follows; the others the tokens and the types that follow it.
    """

    def merge(key: tuple[pa.Scalar], rows: pa.Table) -> pa.Table:
        parts = []
        for row in rows.to_pylist():
            firsts, words = (np.frombuffer(row[c], np.uint64) for c in ("firsts", "words"))
            runs, n = (np.frombuffer(row[c], np.uint32) for c in ("runs", "counts"))
            parts.append((np.repeat(firsts, runs), words, n.astype(np.int64)))
        before, word, n = _ordered(*(np.concatenate(x) for x in zip(*parts, strict=True)))
        keys = pair_keys(before, word)
        order = np.argsort(keys)
        stem, ordered = f"pairs-{key[0].as_py()}", n[order]
        large = np.flatnonzero(ordered >= LARGE)
        save(folder, f"{stem}.keys", keys[order])
        save(folder, f"{stem}.counts", np.minimum(ordered, LARGE).astype(np.uint8))
        save(folder, f"{stem}.large", np.column_stack([large, ordered[large]]).astype(np.int64))
        firsts, at = np.unique(before, return_index=True)
        seconds, follows = np.unique(word, return_counts=True)
        every = np.union1d(firsts, seconds)
        out = {c: np.zeros(len(every), np.int64) for c in names[1:]}
        out["before"][np.searchsorted(every, seconds)] = follows
        place = np.searchsorted(every, firsts)
        for name, values in (
            ("after", n),
            ("types", np.ones_like(n)),
            *((x, (n == k).astype(np.int64)) for k, x in enumerate(names[4:], 1)),
        ):
            out[name][place] = np.add.reduceat(values, at) if len(at) else values
        return pa.table({"word": every.view(np.int64), **out})

    names = ["word", "before", "after", "types", "once", "twice", "thrice", "four"]
    schema = ", ".join(f"{c} long" for c in names)
    partial = packed.groupBy("shard").applyInArrow(merge, schema)
    return partial.groupBy("word").agg(*[F.sum(c).alias(c) for c in names[1:]])


def _write_words(words: DataFrame, folder: str, n_shards: int) -> None:
    """Writes the words' numbers as sorted arrays, dealt to files by hash; a shard that no word is
    in has empty ones."""

    def write(key: tuple[pa.Scalar], rows: pa.Table) -> pa.Table:
        rows = rows.filter(rows["word"].is_valid())
        keys = rows["word"].to_numpy().view(np.uint64)
        order = np.argsort(keys)
        save(folder, f"words-{key[0].as_py()}.keys", keys[order])
        for name in WORD_COLUMNS:
            save(folder, f"words-{key[0].as_py()}.{name}", rows[name].to_numpy()[order])
        return pa.table({"shard": [key[0].as_py()]})

    # Words are hashes already; their low bits deal them evenly.
    shard = F.pmod("word", F.lit(n_shards))
    every = words.sparkSession.range(n_shards).select(F.col("id").alias("shard"))
    dealt = words.select(shard.alias("shard"), "word", *WORD_COLUMNS)
    dealt = dealt.unionByName(every, allowMissingColumns=True)
    written = dealt.groupBy("shard").applyInArrow(write, "shard long").count()
    assert written <= n_shards


def discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """What counts of one, two and more lose, from how many counts are 1, 2, 3 and 4."""
    if not (n1 and n2 and n3 and n4):
        return FALLBACK
    y = n1 / (n1 + 2 * n2)
    found = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
    return tuple(min(max(d, 0.0), k) for k, d in enumerate(found, 1))  # type: ignore[return-value]


@dataclass
class Model:
    """Where the arrays are, and the numbers that hold for all words."""

    folder: str
    pair_files: int
    word_files: int
    hot: np.ndarray
    n: int
    vocabulary: int
    types: int
    pair_discounts: tuple[float, float, float]
    word_discounts: tuple[float, float, float]
    word_rest: float

    def _maps(self, stem: str, columns: dict[str, type]) -> list[np.ndarray]:
        """One shard's arrays. A file that is missing or cut off is an error: without it, words
        would count as never seen."""
        found, lengths = [], set()
        for column, kind in columns.items():
            path = os.path.join(self.folder, f"{stem}.{column}")
            try:
                n, over = divmod(os.path.getsize(path), np.dtype(kind).itemsize)
            except FileNotFoundError as error:
                raise RuntimeError(f"model file {path} is missing here; is its folder mounted?") from error
            lengths.add(n)
            if over or len(lengths) > 1:
                raise RuntimeError(f"model file {path} has not the length of the others")
            found.append(np.memmap(path, dtype=kind, mode="r") if n else np.zeros(0, kind))
        return found

    def _find(self, stem: str, columns: dict[str, type], shard: np.ndarray, keys: np.ndarray) -> list:
        """The columns' values for each key, 0 where it isn't there. Shards are opened one by one."""
        out = [np.zeros(len(keys), np.int64) for _ in columns]
        order = np.lexsort((keys, shard))
        cuts = np.flatnonzero(np.diff(shard[order], prepend=-1))
        for a, b in zip(cuts, [*cuts[1:], len(order)], strict=True):
            own = order[a:b]
            table, *values = self._maps(f"{stem}-{shard[own[0]]}", {"keys": np.uint64, **columns})
            if not len(table):
                continue
            at = np.minimum(np.searchsorted(table, keys[own]), len(table) - 1)
            there = table[at] == keys[own]
            for column, found in zip(out, values, strict=True):
                taken = found[at[there]]
                if stem == "pairs":
                    taken = self._with_large(f"{stem}-{shard[own[0]]}", at[there], taken)
                column[own[there]] = taken
        return out

    def _with_large(self, stem: str, at: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """The counts of the pairs at the places ``at`` of a shard."""
        out = codes.astype(np.int64)
        large = np.flatnonzero(codes == LARGE)
        if len(large):
            path = os.path.join(self.folder, f"{stem}.large")
            places = np.memmap(path, dtype=np.int64, mode="r").reshape(-1, 2)
            out[large] = places[np.searchsorted(places[:, 0], at[large]), 1]
        return out

    def score(self, texts: pa.Array) -> list[np.ndarray]:
        """(n_tokens, n_known, base_score, score) of each text."""
        text, word, before = tokens(texts)
        n_texts = len(texts)
        distinct, at = np.unique(np.concatenate([word, before]), return_inverse=True)
        kinds = dict.fromkeys(WORD_COLUMNS, np.int64)
        facts = self._find("words", kinds, distinct.view(np.int64) % self.word_files, distinct)
        n, follows = (facts[k][at[: len(word)]] for k in (0, 1))
        after, types, once, twice = (facts[k][at[len(word) :]] for k in (2, 3, 4, 5))
        pairs, where = np.unique(pair_keys(before, word), return_index=True)
        shard = pair_shards(before[where], word[where], self.hot, self.pair_files)
        (found,) = self._find("pairs", {"counts": np.uint8}, shard, pairs)
        count = found[np.searchsorted(pairs, pair_keys(before, word))]
        d1, d2, d3 = self.pair_discounts
        known = np.maximum(after, 1)
        cut = np.choose(np.minimum(count, 3), [0, d1, d2, d3])
        rest = (d1 * once + d2 * twice + d3 * (types - once - twice)) / known
        w1, w2, w3 = self.word_discounts
        low = np.maximum(follows - np.choose(np.minimum(follows, 3), [0, w1, w2, w3]), 0)
        low = low / max(self.types, 1) + self.word_rest / (self.vocabulary + 1)
        p = np.where(after > 0, np.maximum(count - cut, 0) / known + rest * low, low)
        base = np.log10((n + 0.5) / (self.n + 0.5 * (self.vocabulary + 1)))
        return [
            np.bincount(text, minlength=n_texts),
            np.bincount(text, weights=n > 0, minlength=n_texts).astype(np.int64),
            np.bincount(text, weights=base, minlength=n_texts),
            np.bincount(text, weights=np.log10(p), minlength=n_texts),
        ]


def _mounted(path: str) -> str:
    """The path as tasks open it."""
    parts = urlparse(path)
    if parts.scheme not in ("", "file"):
        raise ValueError(f"model files are mapped into memory and need a mounted folder, not {path}")
    return parts.path


def fit(docs: DataFrame, shard_bytes: int = SHARD_BYTES) -> Model:
    """Counts the texts of ``docs`` and writes the model under the shared folder."""
    spark = docs.sparkSession
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    folder = _mounted(scratch_path(spark, "kneser-ney"))
    os.makedirs(folder, exist_ok=True)
    n_bytes = docs.agg(F.sum(F.octet_length("text").cast("bigint"))).first()[0] or 0
    n_shards = max(1, math.ceil(n_bytes / shard_bytes))
    counts = count_words(docs).checkpoint()
    n, vocabulary = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    # At most four words for each shard can be so frequent.
    often = counts.where(F.col("n") * (4 * n_shards) > F.lit(n)).select("word").collect()
    hot = np.sort(np.array([row.word % (1 << 64) for row in often] + [int(BEGIN)], dtype=np.uint64))
    seen = _write_pairs(count_pairs(docs, hot, n_shards), folder)
    words = counts.join(seen, "word", "full").na.fill(0).checkpoint()

    def of_counts(column: str) -> list:
        return [F.count(F.when(F.col(column) == k, 1)) for k in (1, 2, 3, 4)]

    sums = [F.coalesce(F.sum(c), F.lit(0)) for c in ("once", "twice", "thrice", "four", "before")]
    *of_pairs, types, w1, w2, w3, w4 = words.agg(*sums, *of_counts("before")).first()
    word_files = max(1, math.ceil(vocabulary / WORDS_PER_SHARD))
    _write_words(words, folder, word_files)
    cut = discounts(w1, w2, w3, w4)
    rest = (cut[0] * w1 + cut[1] * w2 + cut[2] * (vocabulary - w1 - w2)) / types if types else 1.0
    return Model(folder, n_shards, word_files, hot, n, vocabulary, types, discounts(*of_pairs), cut, rest)


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` (``doc_id``, ``text`` and others) without the text, with the scores."""
    ship_package(docs.sparkSession)
    names = [c for c in docs.columns if c not in ("text", "n_tokens", "n_known", "base_score", "score")]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                n_tokens, n_known, base, model_score = model.score(part.column("text"))
                yield pa.record_batch(
                    [
                        *[part.column(c) for c in names],
                        *(pa.array(x) for x in (n_tokens, n_known, base, model_score)),
                    ],
                    names=[*names, "n_tokens", "n_known", "base_score", "score"],
                )

    kept = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in names)
    schema = f"{kept}, n_tokens long, n_known long, base_score double, score double"
    return docs.select(*names, "text").mapInArrow(score, schema)


def report(docs: DataFrame) -> DataFrame:
    """Learns from the documents that aren't held out and scores all of them."""
    number = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    held = docs.select("doc_id", "text", (number % 5 == 1).alias("held_out"))
    model = fit(held.where("NOT held_out"))
    return scored(held, model).select(
        "doc_id",
        "held_out",
        "n_tokens",
        "n_known",
        F.lit(model.n).cast("bigint").alias("train_tokens"),
        "base_score",
        "score",
    )
