import re
from collections import Counter, defaultdict

import pytest

from chorale.llm import source_divergence as sd
from tests.llm import odd

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def expected(rows, min_docs, top):
    """Every pair over all kept terms, every document on its own."""
    docs, counts, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for _, text, lang, source, *_ in rows:
        lang, source = lang or "", source or ""
        terms = TERM.findall((text or "").translate(odd.LOWER))
        groups[lang].add(source)
        docs[lang].update(set(terms))
        counts[lang, source].update(terms)
    out = []
    for lang, sources in groups.items():
        kept = sorted(t for t, n in docs[lang].items() if n >= min_docs)
        v = len(kept)
        totals = {s: sum(counts[lang, s][t] for t in kept) for s in sources}
        price = lambda n, total: 1 + 10**9 * (n + 5) // (total + 5 * v)
        prices = {s: [price(counts[lang, s][t], totals[s]) for t in kept] for s in sources}
        whole = [price(sum(counts[lang, s][t] for s in sources), sum(totals.values())) for t in kept]
        for s in sources:
            apart = [(o, sum(abs(a - b) for a, b in zip(prices[s], prices[o], strict=True))) for o in sources - {s}]
            above = [(t, p - q) for t, p, q in zip(kept, prices[s], whole, strict=True) if counts[lang, s][t] and p > q]
            for part, items, limit in (("pair", apart, None), ("term", above, top)):
                ranked = sorted(items, key=lambda x: (-x[1], x[0].encode()))[:limit]
                out += [(lang, s, part, item, value, k + 1) for k, (item, value) in enumerate(ranked)]
    return out


def many(n_sources):
    """Copies over all sources, texts of single sources, ties, and a language of one source."""
    rows = [(k, "common words that all share, Common!", "en", f"s{k % n_sources}", 0) for k in range(3 * n_sources)]
    rows += [(k, f"own{k % n_sources} own{k % n_sources} some words", "en", f"s{k % n_sources}", 0) for k in range(2 * n_sources)]
    rows += [(k, "ab cd ab", "xx", "alone", 0) for k in range(4)]
    rows += [(k, "ein wort", "de", f"q{k}", 0) for k in range(3)] + [(9, "1 2 3", "zz", f"n{k}", 0) for k in range(3)]
    return rows


@pytest.mark.parametrize("min_docs", [1, 2, 1000])
def test_audit_equals_plain_python_on_odd_texts(spark, min_docs):
    docs = odd.clashing(odd.table(spark))
    found = sd.audited(docs, min_docs=min_docs, top_terms=7).collect()
    odd.same_rows(found, expected(odd.rows(), min_docs, 7))


def test_tiles_and_blocks_change_nothing(spark, monkeypatch):
    rows = many(13)
    docs = spark.createDataFrame(rows, odd.SCHEMA)
    monkeypatch.setattr(sd, "TILE", 3)
    monkeypatch.setattr(sd, "BLOCK_ROWS", 5)
    odd.same_rows(sd.audited(docs, min_docs=2).collect(), expected(rows, 2, 50))


def test_copies_are_collapsed_to_one_text(spark):
    rows = [(k, "one text in a third of all rows", "en", f"s{k % 2}", 0) for k in range(3000)]
    rows += [(k, f"text {k}", "en", "s0", 0) for k in range(6000)]
    docs = spark.createDataFrame(rows, odd.SCHEMA).repartition(16)
    found = sd.collapsed(docs)
    assert found.count() == 6001
    hot = found.where("text LIKE 'one text%'").first()
    assert sorted(tuple(x) for x in hot.copies) == [("s0", 1500), ("s1", 1500)]


def test_rows_in_hand_change_nothing(spark, monkeypatch):
    import pyarrow as pa

    batch = pa.record_batch(
        {
            "lang": ["en", "de"],
            "text": ["a b a", "c ä"],
            "copies": [[{"source": f"s{k}", "n": k + 1} for k in range(5)], [{"source": "s0", "n": 2}]],
        }
    )
    whole = sorted(tuple(r.values()) for part in sd._counted(batch) for r in part.to_pylist())
    monkeypatch.setattr(sd, "ROWS_AT_ONCE", 2)
    parts = [part for part in sd._counted(batch)]
    assert len(parts) > 1
    assert sorted(tuple(r.values()) for part in parts for r in part.to_pylist()) == whole
    assert ("en", "s4", "a", 5, 10) in whole and ("de", "s0", "ä", 2, 2) in whole


def test_empty_table_gives_empty_table(spark):
    assert sd.audited(odd.table(spark).limit(0)).collect() == []


@pytest.mark.parametrize("sent", [1 << 20, 0])
def test_counts_of_terms_are_never_broadcast(spark, monkeypatch, sent):
    """Their file is small beside their rows, so its size must not decide."""
    monkeypatch.setattr(sd, "GROUPS_SENT", sent, raising=False)
    rows = many(13)
    docs = spark.createDataFrame(rows, odd.SCHEMA)
    found = sd.audited(docs, min_docs=2)
    plan = found._jdf.queryExecution().executedPlan().toString()
    joins = re.findall(r"(?:SortMerge|BroadcastHash|ShuffledHash)Join .*", plan)
    assert joins and not any("BuildLeft" in join for join in joins)
    assert all(("BroadcastHashJoin" in join) == (sent != 0) for join in joins)
    odd.same_rows(found.collect(), expected(rows, 2, 50))
