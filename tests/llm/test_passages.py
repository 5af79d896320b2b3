"""Benchmark windows and repeated passages."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from chorale.llm import decontaminate, substrings
from tests.llm import odd


def windows(words, length):
    if len(words) >= length:
        return {tuple(words[i : i + length]) for i in range(len(words) - length + 1)}
    return {tuple(words)} if words else set()


def expected_hits(docs, items, length=10):
    owners = defaultdict(set)
    for item_id, text in items:
        for w in windows(odd.plain(text), length):
            owners[w].add("" if item_id is None else str(item_id))
    out = []
    for doc_id, text in docs:
        words, hit, found = odd.plain(text), set(), set()
        for n in {len(w) for w in owners}:
            for i in range(len(words) - n + 1):
                if owner := owners.get(tuple(words[i : i + n])):
                    hit.update(range(i, i + n))
                    found |= owner
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc_id, len(words), len(hit), len(found), digest, bool(hit)))
    return out


ITEMS = [
    (1, "one two"),
    (2, "THE quick brown fox jumps over the lazy dog near the"),
    (22, "quick brown fox jumps over the lazy dog near the river bank"),
    (3, " ".join(f"shared{k}" for k in range(5, 30))),
    (4, None),
    (5, "..."),
    (None, "école straße"),
    (6, "x"),
    (6, "x"),
    (7, "the the the the the the the the the the the the"),
]


@pytest.mark.parametrize("filter_longs", [1, 1 << 20])
def test_windows_equal_brute_force(spark, filter_longs):
    docs = odd.clashing(odd.table(spark))
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    found = decontaminate.marked(docs, items, filter_longs=filter_longs)
    expected = expected_hits([r[:2] for r in odd.rows()], ITEMS)
    got = [
        (r.doc_id, r.n_words, r.n_hit, len(r["items"]),
         hashlib.sha256(",".join(r["items"]).encode()).hexdigest(), r.n_hit > 0)
        for r in found.collect()
    ]
    odd.same_rows(got, expected)
    odd.same_rows(decontaminate.report(docs, items).collect(), expected)


def test_clean_documents_stay_whole(spark):
    docs = odd.clashing(odd.table(spark))
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    left = decontaminate.without_contaminated(docs, items)
    assert left.select(docs.columns).schema == docs.schema
    clean = Counter(r[0] for r in expected_hits([r[:2] for r in odd.rows()], ITEMS) if not r[-1])
    assert Counter(r.doc_id for r in left.collect()) == clean
    for none in (docs.limit(0), docs):
        left = decontaminate.without_contaminated(none, items.limit(0))
        assert left.count() == none.count()


def test_few_words_and_many_copies_equal_brute_force(spark):
    """Shingles that nearly all windows share, ties of rarity, and a third of all rows equal."""
    deal = random.Random(5)
    say = lambda n, m: " ".join(f"w{deal.randrange(m)}" for _ in range(n))
    items = [(k, say(deal.choice([1, 2, 3, 9, 10, 11, 40]), deal.choice([1, 2, 3]))) for k in range(40)]
    items += [(k, items[-1][1]) for k in range(100, 120)]
    docs = [(k, say(deal.randrange(60), deal.choice([1, 2, 3]))) for k in range(200)]
    docs += [(k, f"before {items[-1][1]} after") for k in range(500, 600)]
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(7)
    found = decontaminate.report(table, spark.createDataFrame(items, "item_id long, text string"))
    odd.same_rows(found.collect(), expected_hits(docs, items))


def test_copies_are_looked_up_once_and_the_filter_is_bounded(spark):
    passage = " ".join(f"shared{k}" for k in range(40))
    docs = spark.range(3000).select("id", F.lit(passage).alias("text")).repartition(5)
    items = docs.select(F.col("id").alias("item_id"), "text")
    shingles = decontaminate.shingled(items, 10)
    assert shingles.count() == 38
    known = decontaminate.filter_of(shingles, 4)
    assert len(known.bits) == 4 and known.sizes == 1 << 3
    near = decontaminate.places(docs, known, 10)
    assert near.count() == 38
    counts = {r.n for r in decontaminate.counted(docs, known).collect()}
    assert counts == {3000}


def without_repeats(docs, length=35):
    seen = Counter()
    for _, text in docs:
        words = odd.spaced(text)
        seen.update(hash(tuple(words[i : i + length])) for i in range(len(words) - length + 1))
    for doc_id, text in docs:
        words = odd.spaced(text)
        gone = set()
        for i in range(len(words) - length + 1):
            if seen[hash(tuple(words[i : i + length]))] > 1:
                gone.update(range(i, i + length))
        kept = [w for i, w in enumerate(words) if i not in gone]
        yield doc_id, len(words), len(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest()


@pytest.mark.parametrize("chunk_bytes", [2_000, 4 << 20])
def test_passages_equal_brute_force(spark, folder, chunk_bytes):
    given = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    for rows in ([r[:2] for r in odd.rows()], given):
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        found = substrings.deduplicated(docs, chunk_bytes=chunk_bytes).collect()
        got = [
            (r.doc_id, r.n_words, r.n_removed,
             hashlib.sha256(" ".join(odd.spaced(r.text)).encode()).hexdigest())
            for r in found
        ]
        odd.same_rows(got, list(without_repeats(rows)))


def test_every_shift_of_a_repeat_is_found(spark):
    """A window of exactly 35 words at all places modulo the period, in both texts."""
    passage = [f"p{k}" for k in range(35)]
    rows = [(s, " ".join([f"a{s}x{k}" for k in range(s)] + passage + [f"z{s}"])) for s in range(22)]
    for a in range(0, 21, 3):
        docs = spark.createDataFrame([rows[a], rows[21]], "doc_id long, text string")
        assert {r.n_removed for r in substrings.deduplicated(docs).collect()} == {35}
    short = [(r[0], r[1].replace("p34", f"other{r[0]}")) for r in rows[:2]]
    docs = spark.createDataFrame(short, "doc_id long, text string")
    assert {r.n_removed for r in substrings.deduplicated(docs).collect()} == {0}


def test_untouched_texts_and_columns_pass_through(spark):
    docs = odd.clashing(odd.table(spark)).drop("n_words", "n_removed")
    found = substrings.deduplicated(docs).collect()
    texts = {(r[0], r[1]) for r in odd.rows()}
    assert all((r.doc_id, r.text) in texts for r in found if not r.n_removed)
    assert {r.chunk for r in found} == {"own chunk"} and len(found) == len(odd.rows())
    assert substrings.deduplicated(docs.limit(0)).collect() == []
    stage = corpus_pipeline.substring_dedup(spark, odd.clashing(docs), "")
    assert stage.schema == odd.clashing(docs).select(stage.columns).schema
    assert {r.n_words for r in stage.collect()} == {"own n_words"}


def test_gaps_around_a_passage_stay(spark):
    rows = [(1, f"Head.\n\n{odd.PASSAGE}\n\nTail."), (2, odd.PASSAGE)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: r.text for r in substrings.deduplicated(docs).collect()} == {1: "Head.\n\nTail.", 2: ""}


def test_equal_rows_are_spread_over_chunks(spark):
    """A third of all rows have no id and one text; they don't meet in one chunk, each is cut as
    any other, and the three steps read one shuffle of the texts."""
    copy = " ".join(f"same{k}" for k in range(40))
    rows = [(None, copy) if k % 3 == 0 else (k, f"{k} own words {k * 7}") for k in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(30)
    spread = substrings._dealt(docs, "doc_id", 50).where("doc_id IS NULL").groupBy("__chunk").count()
    assert max(r["count"] for r in spread.collect()) < 1000 / 4
    found = substrings.deduplicated(docs, chunk_bytes=2000)
    cut = sorted((r.doc_id or -1, r.n_words, r.n_removed, r.text) for r in found.collect())
    assert cut[:1000] == [(-1, 40, 40, "")] * 1000
    assert cut[1000:] == [(k, 4, 0, text) for k, text in rows if k is not None]
    final = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert len(re.findall(r"- Exchange hashpartitioning\(__chunk", final)) == 1
