from collections import Counter, defaultdict

import pandas as pd
import pytest

from chorale.llm import packing
from tests.llm import odd


def plain_pack(rows, p):
    """Best fit over all open bins by looking at every one."""
    out, bins = [], []
    for doc_id, source, cluster, n in sorted(rows, key=lambda r: (-(r[3] % p.capacity), r[0], r[2])):
        if not n:
            out.append((doc_id, 0, 0, 0, None, None))
            continue
        full, rest = divmod(n, p.capacity)
        for k in range(full):
            bins.append([p.capacity, Counter(), set()])
            out.append((doc_id, k, k * p.capacity, p.capacity, len(bins) - 1, 0))
        if rest:
            fits = [
                (p.capacity - used, b)
                for b, (used, sources, clusters) in enumerate(bins)
                if 0 < used < p.capacity and p.capacity - used >= rest
                and sources[source] < p.per_source and cluster not in clusters
            ]
            if fits:
                b = min(fits)[1]
            else:
                bins.append([0, Counter(), set()])
                b = len(bins) - 1
            out.append((doc_id, full, full * p.capacity, rest, b, bins[b][0]))
            bins[b][0] += rest
            bins[b][1][source] += 1
            bins[b][2].add(cluster)
    return out


@pytest.mark.parametrize("per_source", [1, 2, 5])
def test_one_group_equals_plain_search(per_source):
    p = packing.Packing(capacity=100, per_source=per_source)
    rows = [(k, f"s{k * k % 5}", f"c{k % 37 if k % 3 else 0}", k * 7919 % 251) for k in range(400)]
    frame = pd.DataFrame(rows, columns=["doc_id", "source", "cluster", "n_words"])
    frame["rest"] = frame["n_words"] % p.capacity
    found = packing.pack_group(frame.sample(frac=1, random_state=1), p)
    found = [tuple(None if pd.isna(x) else int(x) for x in r) for r in found.itertuples(index=False)]
    odd.same_rows(found, plain_pack(rows, p))


def check_bins(found, facts, p):
    bins = defaultdict(list)
    for r in found:
        if r.bin_id is not None:
            bins[r.bin_id].append(r)
    for own in bins.values():
        own.sort(key=lambda r: r.bin_offset)
        at = 0
        for r in own:
            assert r.bin_offset == at
            at += r.length
        assert at <= p.capacity
        assert max(Counter(facts[r.doc_id][1] for r in own).values()) == 1
        assert max(Counter(facts[r.doc_id][0] for r in own).values()) <= p.per_source
    return bins


def test_all_documents_are_packed_without_conflicts(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    p = packing.Packing(group_rows=50)
    measured = packing.measured(odd.clashing(docs))
    facts = {r.doc_id: (r.source, r.cluster, r.n_words) for r in measured.collect()}
    found = packing.packed(measured, p).collect()
    bins = check_bins(found, facts, p)
    words = Counter()
    for r in found:
        words[r.doc_id] += r.length
    assert words == {k: len(odd.spaced(t)) for k, t in docs.select("doc_id", "text").collect()}
    assert sum(words.values()) > 0.8 * len(bins) * p.capacity


def test_a_third_of_one_source_and_copies(spark):
    rows = [(k, "hot" if k % 3 == 0 else f"s{k % 17}", "same" if k % 3 == 1 else f"c{k}", 1 + k % 90) for k in range(3000)]
    frame = spark.createDataFrame(rows, "doc_id long, source string, cluster string, n_words long")
    p = packing.Packing(capacity=200, group_rows=500)
    found = packing.packed(frame, p).collect()
    assert sorted(r.doc_id for r in found) == list(range(3000))
    check_bins(found, {r[0]: r[1:3] for r in rows}, p)


def test_odd_rows(spark):
    found = packing.packed(packing.measured(odd.clashing(odd.table(spark)))).collect()
    lengths = Counter()
    for r in found:
        lengths[r.doc_id] += r.length
    expected = Counter()
    for r in odd.rows():
        expected[r[0]] += len(odd.spaced(r[1]))
    assert +lengths == +expected
    assert sum(r.bin_id is None for r in found) == 3
    assert packing.packed(packing.measured(odd.table(spark).limit(0))).collect() == []


def test_equal_rows_are_spread_over_groups(spark):
    """A third of all rows are equal: no group holds a good part of them, and none is lost."""
    p = packing.Packing(capacity=100, group_rows=100, copy_run=8)
    rows = [(None, "s", "c", 30) if k % 3 == 0 else (k, f"s{k % 40}", f"c{k}", k % 90 + 1) for k in range(6000)]
    facts = spark.createDataFrame(rows, "doc_id long, source string, cluster string, n_words long")
    found = packing.packed(facts, p).collect()
    assert Counter(r.doc_id for r in found) == Counter(r[0] for r in rows)
    assert sum(r.length for r in found) == sum(r[3] for r in rows)
    copies = [r for r in found if r.doc_id is None]
    assert len({r.bin_id for r in copies}) == len(copies) == 2000
    groups = Counter(r.bin_id >> 32 for r in found)
    assert max(groups.values()) < 3 * p.group_rows
