"""How far the sources of a language are apart in their words, each different text read once.

Identical texts of a language are collapsed: a text is kept once, with how many documents
each source has of it. It is cut into terms once, and what is found counts for each source
as often as the source has the text. So a passage copied a million times is tokenised once,
and a copy in another source costs one row.

Terms in fewer than ``min_docs`` documents of their language are dropped. A kept term with
``n`` occurrences in a group of ``total`` has the price
``1 + (10^9 (n + 5)) div (total + 5 V)``, where V counts the language's kept terms; the
price of a language comes from its own sums. All of it is integer arithmetic.

Two sources are compared by the sum of differences of their prices over all kept terms.
Only terms that one of them has are looked at: all terms a source lacks share one price. For
a pair, what each has against the other's common price comes from sorted prices and their
sums; terms that both have are found by their numbers and set right; all others add the same
difference. Terms are dealt into blocks by hash, and the sources of a language into tiles of
about ``TILE``, so that a task holds a block of terms for two tiles whatever their numbers;
sums of the blocks are added up in Spark.

Defined results for odd input: null texts, languages and sources count as empty strings; a
text without letters has no terms, but its group is there; equal rows are documents of their
own; a language without kept terms has the value 0 for all its pairs; a language of one source has
no pairs. Other columns are left out whatever their names; an empty table gives an empty
table. Texts are the same if their 128-bit digests are.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chorale.llm.words import coded_words, slices
from chorale.session import Workspace, scratch_path, ship_package

MIN_DOCS = 30
TOP_TERMS = 50
SCALE = 1_000_000_000
SMOOTHING = 5
# Rows of (source, term) in a block on average, sources in a tile, and rows in hand at once.
BLOCK_ROWS = 100_000
TILE = 256
ROWS_AT_ONCE = 1 << 20
SLICE_BYTES = 4 << 20
# Bytes of groups that are sent to all tasks, and those of a group besides its names.
GROUPS_SENT, GROUP_BYTES = 8 << 20, 64

# Letters of ASCII and all bytes beyond it belong to terms.
_IN_TERM = np.zeros(256, dtype=bool)
_IN_TERM[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def collapsed(docs: DataFrame) -> DataFrame:
    """(lang, text, copies): each different text of a language, and how many each source has.

    Copies are counted, and one text of them is picked, before anything is shuffled, so a
    text that fills the table comes to its task in one row from each partition.
    """
    read = docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    read = read.withColumn("digest", F.unhex(F.md5("text")))
    copies = (
        read.groupBy("lang", "digest", "source")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("lang", "digest")
        .agg(F.collect_list(F.struct("source", "n")).alias("copies"))
    )
    texts = read.groupBy("lang", "digest").agg(F.first("text").alias("text"))
    return texts.join(copies, ["lang", "digest"]).select("lang", "text", "copies")


def _summed(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    distinct, place = np.unique(keys, return_inverse=True)
    sums = []
    for value in values:
        total = np.zeros(len(distinct), dtype=np.int64)
        np.add.at(total, place, value)
        sums.append(total)
    return (distinct, *sums)


def _counted(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """(lang, source, term, docs, n) of a slice of collapsed texts."""
    text, _, _, code, terms = coded_words(part.column("text"), _IN_TERM)
    if not len(text):
        return
    size = len(terms)
    held, times = np.unique(text * size + code, return_counts=True)
    owner, code = held // size, held % size
    copies = part.column("copies")
    sources = copies.flatten().field("source").dictionary_encode()
    of_source = sources.indices.to_numpy().astype(np.int64)
    n_copies = copies.flatten().field("n").to_numpy()
    begins = copies.offsets.to_numpy().astype(np.int64)
    begins = begins - begins[0]
    langs = part.column("lang").dictionary_encode()
    of_lang = langs.indices.to_numpy().astype(np.int64)
    spread = np.diff(begins)[owner]
    ends = np.cumsum(spread)
    row = 0
    while row < len(owner):
        done = ends[row - 1] if row else 0
        stop = max(row + 1, int(np.searchsorted(ends, done + ROWS_AT_ONCE, "right")))
        index = np.repeat(np.arange(row, stop), spread[row:stop])
        copy = begins[owner[index]] + np.arange(len(index)) - np.repeat(ends[row:stop] - spread[row:stop] - done, spread[row:stop])
        group = of_lang[owner[index]] * len(sources.dictionary) + of_source[copy]
        n = n_copies[copy]
        keys, docs, occurrences = _summed(group * size + code[index], n, n * times[index])
        group = keys // size
        yield pa.record_batch(
            [
                langs.dictionary.take(pa.array(group // len(sources.dictionary))).cast(pa.string()),
                sources.dictionary.take(pa.array(group % len(sources.dictionary))).cast(pa.string()),
                terms.take(pa.array(keys % size)).cast(pa.string()),
                pa.array(docs),
                pa.array(occurrences),
            ],
            names=["lang", "source", "term", "docs", "n"],
        )
        row = stop


def term_counts(texts: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(lang, source, term, n, total, first) of the kept terms a source has.

    ``total`` is the term's count in the language; ``first`` marks one row of each term.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                yield from _counted(part)

    found = texts.mapInArrow(count, "lang string, source string, term string, docs long, n long")
    counts = found.groupBy("lang", "source", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("n"))
    # A term has one row for each source here.
    of_term = Window.partitionBy("lang", "term")
    return (
        counts.withColumn("in_docs", F.sum("docs").over(of_term))
        .where(F.col("in_docs") >= min_docs)
        .select(
            "lang",
            "source",
            "term",
            "n",
            F.sum("n").over(of_term).alias("total"),
            (F.min("source").over(of_term) == F.col("source")).alias("first"),
        )
    )


def _price(n: Column | str, total: str, kept: str) -> Column:
    return F.expr(
        f"""CAST(1 + (CAST({SCALE} AS DECIMAL(20, 0)) * CAST({n} + {SMOOTHING} AS DECIMAL(18, 0)))
        div CAST({total} + {SMOOTHING} * {kept} AS DECIMAL(20, 0)) AS BIGINT)"""
    )


def _groups(docs: DataFrame, counts: DataFrame) -> DataFrame:
    """(lang, source, n_group, n_lang, v, tiles, absent): each group, the sums of its language,
    and the price of a term that the group lacks (null without kept terms)."""
    there = docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source")]).distinct()
    found = counts.select("lang", "source", "n", F.col("first").cast("bigint").alias("first"))
    rows = found.unionByName(there.withColumns({"n": F.lit(0).cast("bigint"), "first": F.lit(0).cast("bigint")}))
    # A group has one row from here on, so a language is few rows.
    groups = rows.groupBy("lang", "source").agg(F.sum("n").alias("n_group"), F.sum("first").alias("firsts"))
    of_lang = Window.partitionBy("lang")
    joined = groups.select(
        "lang",
        "source",
        "n_group",
        F.sum("n_group").over(of_lang).alias("n_lang"),
        F.sum("firsts").over(of_lang).alias("v"),
        F.ceil(F.count(F.lit(1)).over(of_lang) / TILE).cast("int").alias("tiles"),
    )
    absent = F.when(F.col("v") > 0, _price("0L", "n_group", "v"))
    return joined.withColumn("absent", absent)


def _with_groups(counts: DataFrame, groups: DataFrame) -> DataFrame:
    """``counts`` beside their group's sums; the groups go to all tasks if they are few.

    The counts compress well, so their file says little of their size in memory, and Spark
    would send them to the driver and all tasks. How they are joined is settled by the groups.
    """
    size = F.sum(F.octet_length("lang") + F.octet_length("source") + F.lit(GROUP_BYTES))
    few = (groups.agg(size).first()[0] or 0) <= GROUPS_SENT
    return counts.join(groups.hint("broadcast" if few else "merge"), ["lang", "source"])


def _dealt(rows: DataFrame) -> DataFrame:
    """Each row for all pairs of tiles (low, high) that its source's tile is in."""
    tile = F.pmod(F.xxhash64("source"), F.col("tiles")).cast("int")
    rows = rows.withColumn("tile", tile).withColumn("other", F.explode(F.expr("sequence(0, tiles - 1)")))
    return rows.withColumns({"low": F.least("tile", "other"), "high": F.greatest("tile", "other")})


def _against(prices: np.ndarray, absent: np.ndarray) -> np.ndarray:
    """The sum of differences of all ``prices`` to each of the common prices."""
    ordered = np.sort(prices)
    sums = np.concatenate([[0], np.cumsum(ordered)])
    below = np.searchsorted(ordered, absent)
    return absent * below - sums[below] + (sums[-1] - sums[below]) - absent * (len(ordered) - below)


def pair_sums(
    row: np.ndarray,
    term: np.ndarray,
    price: np.ndarray,
    absent: np.ndarray,
    left: np.ndarray,
    right: np.ndarray,
) -> np.ndarray:
    """For sources ``left`` x ``right``: the sum over this block's terms that either has of
    the difference of their prices, less that of their common prices.

    ``row`` is the source of each (term, price), ``absent`` each source's common price.
    """
    out = np.zeros((len(left), len(right)), dtype=np.int64)
    gap = np.abs(absent[left][:, None] - absent[right][None, :])
    for place, source in enumerate(left):
        own = price[row == source]
        out[place] += _against(own, absent[right]) - len(own) * gap[place]
    for place, source in enumerate(right):
        own = price[row == source]
        out[:, place] += _against(own, absent[left]) - len(own) * gap[:, place]
    # Terms that both have were counted for each of them.
    order = np.argsort(term, kind="stable")
    row, term, price = row[order], term[order], price[order]
    at_left, at_right = (np.full(len(absent), -1) for _ in range(2))
    at_left[left], at_right[right] = np.arange(len(left)), np.arange(len(right))
    one, two = np.flatnonzero(at_left[row] >= 0), np.flatnonzero(at_right[row] >= 0)
    low = np.searchsorted(term[two], term[one], "left")
    counts = np.searchsorted(term[two], term[one], "right") - low
    ends = np.cumsum(counts)
    begin = 0
    while begin < len(one):
        done = ends[begin - 1] if begin else 0
        stop = max(begin + 1, int(np.searchsorted(ends, done + ROWS_AT_ONCE, "right")))
        number = np.repeat(np.arange(begin, stop), counts[begin:stop])
        inner = np.arange(len(number)) - (ends - counts - done)[number]
        a, b = one[number], two[low[number] + inner]
        x, y = at_left[row[a]], at_right[row[b]]
        both = np.abs(price[a] - price[b]) + gap[x, y]
        both -= np.abs(price[a] - absent[row[b]]) + np.abs(price[b] - absent[row[a]])
        np.add.at(out, (x, y), both)
        begin = stop
    return out


def _pair_rows(rows: pa.Table, groups: pa.Table) -> pa.Table:
    """Both directions of all pairs of a block and two tiles."""
    schema = pa.schema([("lang", pa.string()), ("source", pa.string()), ("item", pa.string()), ("value", pa.int64())])
    groups = groups.sort_by("source")
    names = groups["source"].to_pylist()
    if not names:
        return schema.empty_table()
    number = {name: k for k, name in enumerate(names)}
    tile = groups["tile"].to_numpy()
    low, high = groups["low"][0].as_py(), groups["high"][0].as_py()
    left, right = np.flatnonzero(tile == low), np.flatnonzero(tile == high)
    v, absent = groups["v"].to_numpy(), groups["absent"].fill_null(0).to_numpy()
    sums = np.zeros((len(left), len(right)), dtype=np.int64)
    if rows.num_rows:
        coded = rows["source"].combine_chunks().dictionary_encode()
        place = np.array([number[x] for x in coded.dictionary.to_pylist()], dtype=np.int64)
        term = rows["term"].combine_chunks().dictionary_encode().indices.to_numpy()
        sums = pair_sums(place[coded.indices.to_numpy()], term, rows["price"].to_numpy(), absent, left, right)
    if groups["block"][0].as_py() == 0:
        sums = sums + v[left][:, None] * np.abs(absent[left][:, None] - absent[right][None, :])
    x, y = (k.ravel() for k in np.meshgrid(left, right, indexing="ij"))
    value = sums.ravel()
    use = x < y if low == high else x != y
    x, y, value = x[use], y[use], value[use]
    named = pa.array(names, pa.string())
    one, two = named.take(pa.array(x)), named.take(pa.array(y))
    lang = pa.array([groups["lang"][0].as_py()] * (2 * len(x)), pa.string())
    values = pa.array(np.concatenate([value, value]))
    return pa.table([lang, pa.concat_arrays([one, two]), pa.concat_arrays([two, one]), values], schema=schema)


def pair_values(priced: DataFrame, groups: DataFrame, n_blocks: int) -> DataFrame:
    """(lang, source, item, value): the divergence of each two sources of a language."""
    block = F.pmod(F.xxhash64("term"), F.lit(n_blocks)).cast("int")
    rows = _dealt(priced.withColumn("block", block)).select(
        "lang", "block", "low", "high", "source", "term", "price"
    )
    blocks = F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1)))
    sides = _dealt(groups.withColumn("block", blocks)).select(
        "lang", "block", "low", "high", "source", "tile", "v", "absent"
    )
    keys = ["lang", "block", "low", "high"]
    sums = (
        rows.groupBy(*keys)
        .cogroup(sides.groupBy(*keys))
        .applyInArrow(_pair_rows, "lang string, source string, item string, value long")
    )
    return sums.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def _ranked(rows: DataFrame, part: str) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return rows.select(
        "lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank")
    )


def audited(docs: DataFrame, min_docs: int = MIN_DOCS, top_terms: int = TOP_TERMS) -> DataFrame:
    """(lang, source, part, item, value, rank) for all groups.

    Part ``pair`` ranks the other sources by divergence, part ``term`` the terms that stand
    out against the language. The counts of kept terms and the groups are written once under
    the run's folder; everything else reads them.
    """
    spark = docs.sparkSession
    ship_package(spark)
    path = scratch_path(spark, "term-counts")
    term_counts(collapsed(docs), min_docs).write.parquet(path)
    counts = spark.read.parquet(path)
    n_blocks = max(1, math.ceil(counts.count() / BLOCK_ROWS))
    groups = Workspace(spark, "divergence").keep(_groups(docs, counts), "groups")
    priced = _with_groups(counts, groups).withColumns(
        {"price": _price("n", "n_group", "v"), "of_lang": _price("total", "n_lang", "v")}
    )
    above = priced.where("price > of_lang").select(
        "lang", "source", F.col("term").alias("item"), (F.col("price") - F.col("of_lang")).alias("value")
    )
    terms = _ranked(above, "term").where(F.col("rank") <= top_terms)
    return _ranked(pair_values(priced, groups, n_blocks), "pair").unionByName(terms)
